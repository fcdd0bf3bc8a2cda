import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = "id key n fp h s size shard slot score label text_key grp block copies_ k0 row part rejected threshold kind".split()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); with further columns whose names may clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING))


def odd_rows():
    """Nulls, empty texts, white space, repeated rows, a very long text and a very long word."""
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "null id text here now"), (None, None), (5, "Ünï cödé \x0b x"),
            (6, "long text " * 20000), (7, "w" * 50000), (8, "one two three four five six"), (9, "ONE two three four five six"), (10, None, None, None)]
