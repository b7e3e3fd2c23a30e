"""The network's derivatives against differences, and what it makes of texts it has not learnt."""

import random
import zlib

import numpy as np
import pytest

from fleetlake.llm import language_id as L
from fleetlake.llm.queries import QUERIES


def test_slopes_equal_differences():
    rng = np.random.default_rng(1)
    network = L.start(("a", "b", "c"), 3, seed=2)
    network = L.Network(network.languages, *(a.astype(np.float64) for a in network.arrays()))
    places = rng.integers(0, 256, (4, 7)).astype(np.int16)
    places[1, 4:] = L.PAD
    places[2, 3] = places[2, 2]
    target = np.array([0, 1, 2, 1])
    _, slopes = L.loss_and_slopes(network, places, target)
    for array, slope in zip(network.arrays(), slopes, strict=True):
        flat, of = array.reshape(-1), slope.reshape(-1)
        used = np.flatnonzero(of)
        for i in rng.choice(used, min(40, len(used)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-5
            above = L.loss_and_slopes(network, places, target)[0]
            flat[i] = kept - 1e-5
            below = L.loss_and_slopes(network, places, target)[0]
            flat[i] = kept
            assert abs((above - below) / 2e-5 - of[i]) < 1e-7


def test_reading_equals_training_and_stops_at_the_end():
    network = L.start(("a", "b"), 4, seed=3)
    rng = np.random.default_rng(4)
    places = rng.integers(0, 256, (3, 9)).astype(np.int16)
    whole = L.read(network, places)
    loss, _ = L.loss_and_slopes(network, places, np.array([0, 1, 1]))
    right = whole[:, np.arange(3), [0, 1, 1]]
    assert abs(-np.log(right).mean() - loss) < 1e-5
    longer = np.concatenate((places, np.full((3, 5), L.PAD, np.int16)), axis=1)
    assert np.allclose(L.read(network, longer)[:9], whole, atol=1e-6)


def test_probabilities_are_means_over_all_bytes():
    network = L.start(("a", "b"), 4, seed=5)
    texts = [b"", b"x", b"some words here", b"longer text " * 30]
    got = L.probabilities(network, texts, length=16)
    for text, found in zip(texts, got, strict=True):
        parts = [text[i : i + 16] for i in range(0, len(text), 16)]
        marks = [L.read(network, L.as_places([p], 16))[: len(p), 0] for p in parts]
        expected = np.concatenate(marks).mean(axis=0) if parts else np.zeros(2)
        assert np.allclose(found, expected, atol=1e-5)


def rows(n, seed):
    rng = random.Random(seed)
    letters = {"xx": ["ka", "to", "ri", "mu"], "yy": ["sch", "ein", "ung", "er"], "zz": ["éa", "ou", "la", "è"]}
    found = []
    for i in range(n):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choices(letters[lang], k=3)) for _ in range(rng.randrange(5, 40)))
        found.append((i, text, lang))
    return found


def table(spark, data):
    full = [(*r, "other", 0.5) for r in data]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, key string, score double")


def test_languages_of_texts_that_were_not_learnt(spark, docs):
    data = rows(400, 1)
    data += [(1000, None, "xx"), (1001, "", None), (1002, "123 --- !!", "yy"), (1003, "éaoula " * 3000, None)]
    data += [(None, "katori", None), (1004, "katori muka", "zz"), (1004, "katori muka", "zz")]
    # a held-out row may say what it likes
    data += [(i, t, "wrong") for i, t, _ in rows(400, 2) if zlib.crc32(str(i).encode()) % 4 == 2]
    df = L.language_id(table(spark, data), steps=150)
    assert df.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = df.collect()
    assert len(found) == len(data)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("xx", "yy", "zz", "und")
    for i in (1000, 1001, 1002):
        assert (by_id[i][0]["lang_pred"], by_id[i][0]["score"]) == ("und", 0)
    assert by_id[1003][0]["lang_pred"] == "zz" and by_id[1004][0]["lang_pred"] == "xx"
    assert by_id[1004][0] == by_id[1004][1]
    truth = {i: lang for i, _, lang in rows(400, 1)}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(by_id[i][0]["lang_pred"] == truth[i] for i in held)
    assert right >= 0.95 * len(held)


def test_no_rows_no_languages_and_one(spark, docs):
    assert L.language_id(table(spark, []).limit(0)).collect() == []
    nothing = L.language_id(table(spark, [(1, "some text", None)])).collect()
    assert [tuple(r) for r in nothing] == [(1, False, "und", 0.0)]
    one = L.language_id(table(spark, [(1, "some text", "en"), (3, "more", None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("en", 1.0)}


def test_the_sample_is_bounded_per_language(spark, docs):
    data = rows(300, 3) + [(5000, "kato " * 50, "xx")] * 300
    windows, langs = L.labelled_windows(table(spark, data), sample=20, cuts=3, length=16)
    assert len(windows) == len(langs) and all(len(w) <= 16 for w in windows)
    assert all(langs.count(g) == 60 for g in ("xx", "yy", "zz"))


def test_held_out_accuracy_of_the_query(spark):
    path = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op13_language_id"](spark, path).join(truth, "doc_id").where("held_out")
    told = found.where("lang_pred <> 'und' AND lang IS NOT NULL")
    right, total = told.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert total > 200 and right >= 0.95 * total
