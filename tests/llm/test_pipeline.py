"""Every pipeline stage, and the whole of it, on tables with clashing and nested columns, nulls, repeats and no rows."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, n_chars long, _th string, _each int, th string, key int, r string, rest int, m map<string,int>, a array<int>, group int"


def _texts():
    r = random.Random(4)
    words = [f"{a}{b}" for a in ("win", "ha", "lo", "mer", "ti") for b in ("dow", "ven", "ter", "gan", "ros", "lin")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    return text


def _odd(spark):
    text = _texts()
    long, item = text(300), "question about harbours " + text(30)
    rows = [(1, long), (2, long), (3, long + " end"), (3, long + " end"), (4, None), (5, ""), (None, None), (None, text(80)), (6, text(50) + " " + item + " " + text(50)), (7, "write to jane@example.org " + text(40)), (8, text(90)), (8, text(90)), (9, text(6000)), (10, "x")]
    rows = [(d, t, "en", len(t or ""), f"t{i}", i, "th", i % 3, "r", i, {"k": i}, [i], 5) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA), item


@pytest.fixture
def sf_dir(spark, tmp_path):
    docs, item = _odd(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3, 6, 7, 8, 9)] + [(10, 0, 0), (5, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def _plain(rows):
    return sorted((repr(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in rows))


def test_stages_keep_every_column(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    for name in list(stages)[:-1]:
        out = stages[name](spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert {f.name: f.dataType for f in out.schema.fields} == {f.name: f.dataType for f in docs.schema.fields}
        if name != "pii":
            assert set(_plain(out.collect())) <= set(_plain(whole)), name
        assert stages[name](spark, docs.limit(0), sf_dir).count() == 0, name
    assert stages["packing"](spark, docs.limit(0), sf_dir).count() == 0


def test_one_row_of_each_group_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
    ids = sorted((r["doc_id"] for r in kept if r["doc_id"] is not None))
    # 1, 2 and 3 are one group; 4, 5 hold no word and link with nothing; of 8's two texts, which differ, both stay
    assert ids == [1, 4, 5, 6, 7, 8, 8, 9, 10] and len(kept) == len(ids) + 2


def test_benchmark_passages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_benchmark(spark, docs, sf_dir).collect()
    assert _plain(kept) == _plain([r for r in docs.collect() if r["doc_id"] != 6])


def test_personal_data_goes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["_each"]: r for r in corpus_pipeline.redact_personal_data(spark, docs, sf_dir).collect()}
    assert len(rows) == docs.count()
    for r in docs.collect():
        got = rows[r["_each"]]
        if r["doc_id"] == 7:
            assert got["text"] == r["text"].replace("jane@example.org", "<EMAIL>") and got["n_chars"] == len(got["text"])
        elif r["doc_id"] != 9:
            assert got["text"] == r["text"]
        assert got["m"] == r["m"] and got["_th"] == r["_th"]


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} <= {None, 1, 4, 5, 7, 8, 9, 10} and {1, 8, 9} <= {r["doc_id"] for r in rows}
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
