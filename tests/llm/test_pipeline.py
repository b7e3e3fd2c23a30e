"""The pipeline's stages on planted cases, and the queries that have SQL."""

import random

import duckdb
import pytest

import corpus_pipeline
from fleetlake.llm import queries
from tests.llm.test_operators import labelled, near_texts, prose

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(queries.ORACLES))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    expected = con.execute(queries.ORACLES[key])
    names = [d[0] for d in expected.description]
    df = queries.QUERIES[key](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    got = sorted(map(repr, map(tuple, df.select(names).collect())))
    assert got == sorted(map(repr, expected.fetchall()))


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(21)
    rows, labels = labelled(rng, 600)
    toxic = {k for k, _, t in labels if t}
    near = near_texts(rng, 1, 6)
    shared = prose(rng, 150)
    passages = [(5000 + i, prose(rng, 40) + " " + shared + " " + prose(rng, 40)) for i in range(3)]
    secret = [(6000, prose(rng, 50) + " password=hunter2hunter2 " + prose(rng, 50))]
    full = [
        (k, t, "en", "src0", len(t or ""))
        for k, t in rows + near + passages + secret + [(7000, None), (None, "nameless words here")]
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    sf_dir = f"file://{tmp_path}"
    spark.createDataFrame(full, schema).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{sf_dir}/labels.parquet"
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf_dir)
    kept = {r["doc_id"] for r in clean.collect()}
    assert len(toxic & kept) <= 0.1 * len(toxic)
    assert len(kept) >= len(full) - 1.05 * len(toxic) and None in kept and 7000 in kept
    one = stages["simhash_near_dedup"](spark, clean, sf_dir)
    names = [r["doc_id"] for r in one.collect()]
    assert len(set(names) & {k for k, _ in near}) < len(near)
    assert {5000, 5001, 5002, 6000} <= set(names) and len(names) == len(set(names))
    unique = stages["suffix_dedup"](spark, one, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in unique.collect()}
    assert not any(shared[10:-10] in (t or "") for t in texts.values()) and texts[7000] is None
    safe = stages["secret_scans"](spark, unique, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in safe.collect()}
    assert "hunter2" not in texts[6000] and "[assign]" in texts[6000]
    for df in (clean, one, unique, safe):
        assert df.columns == docs.columns
    packed = stages["packing"](spark, safe, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(texts)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(whole.columns) == sorted(packed.columns)
    assert whole.agg({"length": "sum"}).first() == packed.agg({"length": "sum"}).first()


def test_stages_of_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    sf_dir = f"file://{tmp_path}"
    spark.createDataFrame([], schema).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{sf_dir}/labels.parquet"
    )
    assert corpus_pipeline.run(spark, sf_dir).collect() == []
