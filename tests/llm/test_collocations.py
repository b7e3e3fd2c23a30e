"""Phrases against a plain count of all of them, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from fleetlake.llm import collocations as C
from fleetlake.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, most, least, share):
    """(lang, text) rows to what the contract says, by counting everything."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        scored = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            cuts = [
                (10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))
            ]
            score, k = min(cuts)
            longer = [
                n for p, n in f.items()
                if len(p) == 3 > len(phrase) and n >= least and phrase in (p[:2], p[1:])
            ]
            if not any(100 * n >= share * a for n in longer):
                text = " ".join(phrase)
                scored.append((-score, -a, text.encode(), text, f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, _, text, left, right) in enumerate(sorted(scored)[:most], 1):
            found.append((lang, rank, text, -a, left, right, total[lang], -score))
    return sorted(found)


def table(spark, rows):
    full = [(i, t, g, "x", 1.0, "y") for i, (g, t) in enumerate(rows)]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, phrase string, score double, slice string"
    )


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def prose(rng, words, size):
    sign = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "! "]
    names = [f"W{min(rng.randrange(size), rng.randrange(size))}" for _ in range(words)]
    return "".join(w + rng.choice(sign) for w in names)


@pytest.mark.parametrize("most, size", [(5, 30), (40, 60)])
def test_phrases_equal_a_plain_count(spark, docs, most, size):
    rng = random.Random(most)
    fixed = ["Alpha beta gamma", "new York city", "new york", "Ünder straße", "a a a a a"]
    rows = [
        (rng.choice(["en", "fr", None]), f"{prose(rng, 60, size)}. {rng.choice(fixed)}; {rng.choice(fixed)}")
        for _ in range(150)
    ]
    rows += [("en", None), ("fr", ""), (None, " \t\n"), ("de", "one two"), ("xx", "pair up " * 12)]
    rows += [("en", "same row again here")] * 12
    expected = plain(rows, most, 10, 50)
    assert got(C.collocations(table(spark, rows), most=most)) == expected
    assert {r[0] for r in expected} >= {"en", "fr", "und", "xx"}


def test_ties_at_the_limit_go_by_occurrences_and_bytes(spark, docs):
    rows = [("en", f"{a}{i} z{i}. ") for i in range(30) for a in "qéZ" for _ in range(10)]
    rows += [("en", "q0 z0")] * 3
    expected = plain(rows, 7, 10, 50)
    assert got(C.collocations(table(spark, rows), most=7)) == expected


def test_limits_are_lowered_until_enough_survive(spark, docs, monkeypatch):
    """The best pairs are all dropped for phrases that score little, so deeper ones are needed."""
    lines = [f"a{i} b{i}{' c' * (n < 11)}" for i in range(20) for n in range(20)]
    lines += [f"common{i % 3} d{i}" for i in range(30) for _ in range(10 + i % 5)]
    rows = [("en", line) for line in lines]
    rounds = []
    inner = C._triples
    monkeypatch.setattr(C, "_triples", lambda *a: rounds.append(1) or inner(*a))
    expected = plain(rows, 10, 10, 50)
    assert got(C.collocations(table(spark, rows), most=10)) == expected
    assert len(rounds) > 1 and any(r[2].startswith("common") for r in expected)


def test_long_texts_are_counted_across_blocks_and_cuts(spark, docs, monkeypatch):
    monkeypatch.setattr(C, "_BLOCK", 50)
    monkeypatch.setattr(C, "_TOKENS", 20)
    rng = random.Random(3)
    rows = [("en", prose(rng, 900, 6)), ("fr", prose(rng, 700, 5)), ("en", "x" * 400 + " y z")]
    blocks = list(C._blocks(b"a b.c D," * 40))
    assert len(blocks) > 3 and sum(blocks, [])[:6] == [b"a", b"b", b".", b"c", b"d", b"."]
    assert got(C.collocations(table(spark, rows), most=50)) == plain(rows, 50, 10, 50)


def test_a_saturated_bitmap_loses_nothing(spark, docs):
    rng = random.Random(4)
    rows = [("en", prose(rng, 80, 20)) for _ in range(60)]
    assert got(C.collocations(table(spark, rows), most=30, bits=6)) == plain(rows, 30, 10, 50)


def test_no_rows_and_no_candidates(spark, docs):
    assert got(C.collocations(table(spark, []).limit(0))) == []
    assert got(C.collocations(table(spark, [("en", "few words here"), (None, None)]))) == []


def test_the_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    path = "/root/testdata/sf0.001"
    con.execute(f"create view documents as select * from '{path}/documents.parquet'")
    expected = con.execute(f"select {', '.join(COLUMNS)} from ({ORACLES['op11_collocations']})")
    assert got(QUERIES["op11_collocations"](spark, path)) == sorted(expected.fetchall())
