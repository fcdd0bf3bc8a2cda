"""Place-name normalisers.

Three different normalisations meet one price-side key, on purpose:
census area names lose a trailing parenthetical and one locality suffix,
supermarket suburbs go through an alias map, school suburbs are only
trimmed and lower-cased. Keep them separate; ``coverage`` reports per source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the source pipeline for identical results) ---
# Trailing locality suffixes removed from census area names, in match order.
PARENT_NAME_SUFFIXES = [
    "central", "north", "south", "east", "west", "central-north", "central-south",
    "north east", "south east", "north west", "south west", "central east",
    "central north", "central south", "nirvana", "konini", "rosier", "woodglen",
    "larnoch", "keegan", "red hills", "seabrook", "tuff crater", "royal road west",
    "valley park", "abbotts park", "waiata", "waiatarua", "waitaramoa", "rosebank",
    "eastridge", "amaru", "oranga", "ferndale", "hamlin", "heights east",
    "heights north west", "heights south west", "mclennan", "massey park",
    "hospital", "eastburn", "south crossing", "hill east", "hill west",
    "parrs park", "industrial",
]

# Supermarket suburb aliases (lower-cased, trimmed name -> canonical suburb).
SUPERMARKET_SUBURB_ALIASES = {
    "mt albert": "mount albert",
    "mt roskill": "mount roskill",
    "mt wellington": "mount wellington",
    "mt eden": "mount eden",
    "auckland cbd": "city centre",
    "manukau city": "manukau",
    "manukau central": "manukau",
    "mangere central": "mangere",
    "botany downs": "botany",
    "takapuna north": "takapuna",
    "te atatu": "te atatu peninsula",
    "te atatu north": "te atatu peninsula",
    "murrays bay": "murrays bay",
    "the gardens": "flat bush",
    "dannemora": "east tamaki",
    "oteha": "albany",
    "pinehill": "albany",
    "clendon": "manurewa",
    "randwick park": "manurewa",
    "wattle downs": "manurewa",
}

# Price-side key rewrite: every 'mt ' becomes 'mount ' (unanchored).
MOUNT_ABBREVIATION = ("mt ", "mount ")

# Trailing parenthetical such as ' (Auckland)'.
TRAILING_PARENTHETICAL = r"\s*\([^)]*\)$"
# --- end of fixed values ---


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suffix_pattern(suffixes: list[str] = PARENT_NAME_SUFFIXES) -> str:
    """Anchored alternation; suffix entries are regex fragments used as given."""
    return r"\s+(" + "|".join(suffixes) + r")$"


def parent_suburb(c: Column | str, suffixes: list[str] = PARENT_NAME_SUFFIXES) -> Column:
    """Census area name -> parent suburb.

    lower -> drop a trailing parenthetical -> drop ONE trailing suffix -> trim.
    Single pass: the result is not idempotent, and a trailing space defeats the
    suffix match because the trim comes last.
    """
    s = F.regexp_replace(F.lower(_col(c)), TRAILING_PARENTHETICAL, "")
    s = F.regexp_replace(s, suffix_pattern(suffixes), "")
    return F.trim(s)


def suburb_key(c: Column | str) -> Column:
    """Price-side join key: trim -> lower -> unanchored 'mt ' -> 'mount '."""
    old, new = MOUNT_ABBREVIATION
    return F.replace(F.lower(F.trim(_col(c))), F.lit(old), F.lit(new))


def plain_suburb(c: Column | str) -> Column:
    """School-side suburb: lower(trim(x)), nothing else."""
    return F.lower(F.trim(_col(c)))


def canonical_supermarket_suburb(
    c: Column | str, aliases: dict[str, str] = SUPERMARKET_SUBURB_ALIASES
) -> Column:
    """Alias map with pass-through default, as one CASE expression."""
    key = F.lower(F.trim(_col(c)))
    expr = None
    for k, v in aliases.items():
        expr = (F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v)))
    return key if expr is None else expr.otherwise(key)
