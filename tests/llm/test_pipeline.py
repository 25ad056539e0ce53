"""The pipeline's stages, one by one and together."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
from tests.llm import data
from tests.llm.test_copies import near_copies
from tests.llm.test_tables import planted


def corpus() -> list[tuple]:
    rng = random.Random(8)
    clean = [(3000 + i, data.prose(rng, 80, ("en", "de", "fr", "es")[i % 4]), ("en", "de", "fr", "es")[i % 4], f"src{i % 3}") for i in range(80)]
    return clean + near_copies(4, 2, 1, start=3500) + planted(12) + [r for r in data.rows() if r[0] is None or r[0] >= 100]


def test_stages_and_run(spark, tmp_path):
    rows = corpus()
    docs = data.documents(spark, rows)
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "secrets", "mixing", "pieces"] and corpus_pipeline.ORACLE_SQL is None
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "pieces":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    clean = set(range(3000, 3080))
    assert clean <= set(kept["language"]) and not {103, 104, 105, 106} & set(kept["language"])
    assert clean <= set(kept["near_duplicates"]) and 3500 in kept["near_duplicates"] and not {3501, 3502, 3503} & set(kept["near_duplicates"])
    assert set(kept["secrets"]) == set(kept["near_duplicates"])
    for i in range(12):
        assert hashlib.sha1(str(i).encode()).hexdigest() not in kept["secrets"][500 + i]
    assert all(r["exact"] for r in docs.collect() if "▁" not in (r["text"] or ""))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: sorted((str(r["doc_id"]), r["text"], r["n_pieces"]) for r in df.collect())
    assert key(whole) == key(docs)


def test_stages_take_an_empty_table(spark):
    docs = data.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
