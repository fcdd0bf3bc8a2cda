"""Stages of the corpus pipeline against plain versions, and the registered queries."""

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.llm.test_text_matching import _components, _edits, _letters
from tussock.llm import decontam, toxicity
from tussock.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(ORACLE) < set(QUERIES)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, SF).cache()
    scored = toxicity.score(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.filter("not rejected").collect()}

    rows = [(r.doc_id, r.text) for r in clean.collect()]
    unique = stages["near_duplicates"](spark, clean, SF).cache()
    assert unique.columns == columns
    assert {r.doc_id for r in unique.collect()} == {i for i, _, c in _components(rows) if i == c}

    items = [_letters(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    pure = stages["decontamination"](spark, unique, SF).cache()
    want = set()
    for r in unique.collect():
        text = _letters(r.text)
        near = [p for p in items if len(p) >= decontam.MIN_WORDS and len(set(p) & set(text)) >= 0.85 * len(set(p)) - 1]
        if not any(_edits(p, text)[0] <= int(len(p) * decontam.ERROR_RATE) for p in near):
            want.add(r.doc_id)
    assert pure.columns == columns and {r.doc_id for r in pure.collect()} == want

    mixed = stages["mixing"](spark, pure, SF).cache()
    assert mixed.columns == columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 3 and set(copies) <= want
    words = {r.doc_id: len(r.text.split()) for r in pure.collect()}
    assert abs(sum(words[i] * n for i, n in copies.items()) / sum(words.values()) - 1) < 0.25

    shards = stages["sharding"](spark, mixed, SF).toPandas()
    assert Counter(shards.doc_id) == copies
    for _, g in shards.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
