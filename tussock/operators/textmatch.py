"""Case-insensitive substring matching of text against a keyword list.

Two forms:

* a literal keyword list compiles to ONE case-insensitive regex alternation,
  evaluated JVM-side per row (``rlike``), NULL text -> no match;
* a keyword table is matched with one plan at every size: each distinct text
  gives its distinct short grams (cut in one pass, so the cost is linear in its
  length), the grams that keywords also have are counted over the texts, and
  each keyword is joined on its rarest gram only, then checked with
  ``contains``. So a beginning that all keywords share is no join key, a
  text and a keyword meet at most once. The texts of a gram are dealt out by a salt.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of the grams that are joined on: a keyword has the longest of them that it can fill.
GRAMS = (6, 3, 1)
# Texts are cut into pieces of so many characters first: positions in a piece are found in constant time.
PIECE = 64
# Texts of a gram are dealt out over so many keys; the keywords, each on one gram, are repeated for them.
SALTS = 16


def keyword_pattern(keywords: list[str], escape: bool = False) -> str:
    parts = [re.escape(k) if escape else k for k in keywords]
    return "(?i)(" + "|".join(parts) + ")"


def contains_any(text: Column, keywords: list[str], escape: bool = False) -> Column:
    """True when ``text`` contains any keyword (case-insensitive); NULL text -> False.

    Keywords are regex fragments joined by ``|``, as a pattern built by joining
    names would be; pass ``escape=True`` for literal keywords with metacharacters.
    """
    return F.coalesce(text.rlike(keyword_pattern(keywords, escape)), F.lit(False))


def with_grams(df: DataFrame, text_col: str, lengths: tuple[int, ...] = GRAMS) -> DataFrame:
    """One row for each distinct gram (``_gram``) of a text, beside the columns of ``df``, in time linear in the text.

    ``lengths`` are at most ``PIECE``. The text is lower-cased and cut into pieces, each with the beginning of the
    next one, so that a gram is found by its place in a piece.
    """
    pieces = df.withColumn("_pieces", F.expr(f"regexp_extract_all(lower(`{text_col}`), '(?s)(.{{1,{PIECE}}})', 1)"))
    cut = ", ".join(f"substring(p.s, i, {n})" for n in lengths)
    grams = (f"array_distinct(flatten(flatten(transform(zip_with(_pieces, slice(concat(_pieces, array('')), 2, size(_pieces)), "
             f"(x, y) -> struct(length(x) AS n, concat(x, substring(y, 1, {max(lengths) - 1})) AS s)), "
             f"p -> transform(sequence(1, p.n), i -> array({cut}))))))")
    kept = f"filter({grams}, g -> length(g) IN ({', '.join(map(str, lengths))}))"
    return pieces.select(*df.columns, F.explode(F.expr(kept)).alias("_gram"))


def _pairs(df: DataFrame, text_col: str, keywords: DataFrame, kw_col: str) -> DataFrame:
    """(``_text``, ``_kw``): each distinct text with every keyword it contains, once."""
    kw = (keywords.select(F.col(kw_col).alias("_kw")).filter(F.col("_kw").isNotNull() & (F.length("_kw") > 0))
          .distinct().withColumn("_low_kw", F.lower("_kw")))
    size = "CASE " + " ".join(f"WHEN length(_low_kw) >= {n} THEN {n}" for n in GRAMS) + " END"
    kw = with_grams(kw, "_kw").filter(F.expr(f"length(_gram) = {size}"))
    texts = df.select(F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    postings = with_grams(texts, "_text")
    # The keywords of a gram go along while its texts are counted, so the keyword frame is evaluated once.
    by_gram = kw.groupBy("_gram").agg(F.collect_list(F.struct("_kw", "_low_kw")).alias("_kws"))
    often = postings.join(by_gram, "_gram").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"), F.first("_kws").alias("_kws"))
    known = often.select("_gram", "_n", F.explode("_kws").alias("_k"))
    rarest = known.groupBy(F.col("_k._kw").alias("_kw"), F.col("_k._low_kw").alias("_low_kw")).agg(F.min(F.struct("_n", "_gram")).alias("_r"))
    dealt = rarest.select("_kw", "_low_kw", F.col("_r._gram").alias("_gram"), F.explode(F.array(*(F.lit(i).cast("long") for i in range(SALTS)))).alias("_salt"))
    spread = postings.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS)))
    return (spread.join(dealt, ["_gram", "_salt"]).filter(F.lower("_text").contains(F.col("_low_kw")))
            .select("_text", "_kw"))


def contains_matches(df: DataFrame, text_col: str, keywords: DataFrame, kw_col: str) -> DataFrame:
    """(Row of ``df``, distinct keyword) pairs where lower(text) contains lower(keyword).

    Output: all columns of ``df``, then ``kw_col``. Empty keywords never match.
    """
    pairs = _pairs(df, text_col, keywords, kw_col)
    return (df.join(pairs, F.col(text_col) == F.col("_text"))
            .select(*df.columns, F.col("_kw").alias(kw_col)))


def semi_join_contains(df: DataFrame, text_col: str, keywords: DataFrame, kw_col: str) -> DataFrame:
    """Rows of ``df`` whose text contains at least one keyword (case-insensitive)."""
    pairs = _pairs(df, text_col, keywords, kw_col)
    return df.join(pairs, F.col(text_col) == F.col("_text"), "left_semi").select(*df.columns)


def mark_contains(df: DataFrame, text_col: str, keywords: DataFrame, kw_col: str, flag_col: str) -> DataFrame:
    """Add a boolean ``flag_col``: text contains any keyword (NULL text -> False).

    Matching runs once per DISTINCT text; the matched texts are joined back on
    the text value (an equi-join), so repeated texts cost nothing extra.
    """
    matched = _pairs(df, text_col, keywords, kw_col).select("_text").distinct()
    return (df.join(matched, F.col(text_col) == F.col("_text"), "left")
            .select(*df.columns, F.col("_text").isNotNull().alias(flag_col)))
