from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from kpiloom.llm import queries
from kpiloom.llm._store import stored

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_run_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "sentencepiece"]
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert 0.5 * before < docs.count() <= before
        before = docs.count()
    assert docs.where("n_tokens <> size(ids) OR n_tokens = 0").count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages_take_odd_rows_and_keep_clean_documents(spark):
    rng = random.Random(15)
    words = "the and of to in is that for with was on as by at from his her they one all".split()

    def clean(n):
        return " ".join(rng.choice(words) + rng.choice(["", "s", "ing", "ed"]) for _ in range(n))

    docs = [(i, clean(60), "en", "s", 9) for i in range(30)] + [(100, clean(40_000), "en", None, None), (None, clean(70), None, "s", 1), (7, clean(50), "en", "t", 2)]
    odd = [(200, None, "en", "s", 0), (201, "", None, None, None), (202, " \t ", "en", "s", 0), (0, docs[0][1], "en", "s", 9), (203, docs[1][1] + " more", "en", "s", 9)]
    df = spark.createDataFrame([(*d, "c", 3) for d in docs + odd], "doc_id long, text string, lang string, source string, n_chars int, key string, node long")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        assert stage(spark, df.limit(0), SF).count() == 0
        df = stored(out)
        kept = sorted((str(r.doc_id), r.text) for r in df.collect() if r.text and len(r.text) > 9)
        if k >= 1:
            assert kept == sorted((str(d[0]), d[1]) for d in docs)
    ids = corpus_pipeline.STAGES[-1][1](spark, df, SF)
    assert ids.count() == df.count() and corpus_pipeline.STAGES[-1][1](spark, df.limit(0), SF).count() == 0
