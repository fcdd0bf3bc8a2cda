"""The registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .brown import class_scores
from .decontam import find_leaks
from .html import main_text
from .jaccard import near_duplicates
from .mixing import mix
from .quantise import embedding_links
from .sharding import shard
from .spelling import spelling_variants
from .suffix import remove_repeats
from .tokencount import token_counts
from .topk import top_k
from .toxicity import score
from .whiten import whiten


#: Vocabulary of the token counts; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_repeats(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), length=200)


def op3_sharding(spark, sf_dir):
    out = shard(table(spark, sf_dir, "documents"), n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op4_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_class_lm(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return class_scores(table(spark, sf_dir, "documents"), learn=fold != 0)


def op6_main_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op7_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def op8_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_jaccard(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=80, n=5).drop("text_key")


def op10_toxicity(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, labels, usable=fold != 2)
    return out.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"), "threshold", "rejected")


def op11_embedding_near_dedup(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"), least=0.93)


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), ratio=5)


def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=16)


def _nibble(x: int) -> int:
    """Four steps of the reflected CRC-32 (polynomial 0xEDB88320)."""
    for _ in range(4):
        x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
    return x


_STEPS = str([_nibble(x) for x in range(16)])
_HALF = "xor({0} >> 4, " + _STEPS + "[1 + ({0} & 15)])"
_CRC_STEP = _HALF.format(_HALF.format("xor(c, b)"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_repeats": op2_repeats,
    "op3_sharding": op3_sharding,
    "op4_topk": op4_topk,
    "op5_class_lm": op5_class_lm,
    "op6_main_text": op6_main_text,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

ORACLE = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(generate_series(1, len(q.e)), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op8_mixing": r"""
        WITH base AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || coalesce(text, '')), 1, 9) AS BIGINT) AS h FROM documents),
        src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
        weighed AS (
            SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM src),
        ranked AS (
            SELECT *, 3 * source_size / weight AS ratio,
                   row_number() OVER up AS place,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
            FROM weighed WINDOW up AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
        goal AS (
            SELECT source, source_size, least(3.0::DOUBLE * source_size, lam * weight) AS target
            FROM ranked CROSS JOIN (SELECT arg_min(level, place) FILTER (level <= ratio) AS lam FROM ranked)),
        lumps AS (SELECT source, h, sum(size) AS words FROM base GROUP BY source, h),
        run AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS before FROM lumps)
        SELECT b.doc_id, b.size, g.source_size, g.target,
               CAST(b.size * least(3, CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)
                    + CASE WHEN r.before + r.words / 2 <= g.target - floor(g.target / g.source_size) * g.source_size THEN 1 ELSE 0 END
                    ELSE 0 END) AS BIGINT) AS taken
        FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source
        JOIN run r ON r.source IS NOT DISTINCT FROM b.source AND r.h = b.h""",
    "op9_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words),
        items AS (SELECT doc_id, unnest(s) AS g FROM sets),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM common JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
            WHERE 100 * c >= 80 * (len(p.s) + len(q.s) - c)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
        SELECT doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(other) AS component_id
        FROM reach JOIN sets USING (doc_id) GROUP BY doc_id""",
    "op11_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
        reach AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other),
        least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
        degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN least USING (vec_id) LEFT JOIN degree ON x = e.vec_id""",
    "op12_spelling_variants": rf"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents),
        low AS (
            SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c FROM runs
            WHERE length(run) >= 6 GROUP BY 1, 2),
        hashed AS (
            SELECT w, c, xor(4294967295, list_reduce(
                list_transform(generate_series(1, strlen(id || ':' || w)), lambda i: CAST('0x' || substr(hex(encode(id || ':' || w)), 2 * i - 1, 2) AS BIGINT)),
                lambda c, b: {_CRC_STEP}, 4294967295::BIGINT)) AS h FROM low),
        counted AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, CAST(sum(c) AS BIGINT) AS n
            FROM hashed GROUP BY 1),
        words AS (SELECT word, n FROM counted WHERE length(word) >= 6 AND n >= 5),
        holes AS (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words),
        cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM holes),
        masked AS (SELECT word, n, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS rest FROM holes),
        near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS m FROM masked a JOIN masked b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
            UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest),
        ranked AS (
            SELECT word, n, other, m, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place FROM near),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word),
        follow AS (
            SELECT word, form, word AS root, form AS up FROM forms
            UNION ALL SELECT f.word, f.form, f.up, g.form FROM follow f JOIN forms g ON g.word = f.up)
        SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN follow r ON r.word = f.word AND r.up IS NULL""",
}
