"""Aligned tokens against the libraries on whole texts, and perfect hashing."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetlake.llm import alignment as A
from fleetlake.llm.perfect_hash import CountTable, PerfectHash
from fleetlake.llm.queries import QUERIES

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """What the contract says, on whole texts and all pairs of tokens."""
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    chars = A.byte_characters()
    byte_of = {c: bytes([b]) for b, c in enumerate(chars)}

    def cut(ids, data):
        ends = np.cumsum([len(d) for d in data]).tolist()
        return list(zip(ids, [0, *ends[:-1]], ends, strict=True))

    rows, documents = [], Counter()
    for text in texts:
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        data_a = [b"".join(byte_of[c] for c in first.id_to_token(i)) for i in a]
        names = [second.id_to_piece(i) for i in b]
        data_b = [
            bytes([int(n[3:5], 16)]) if second.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in zip(b, names, strict=True)
        ]
        if not text or not b"".join(data_a) == b"".join(data_b) == f" {text}".encode():
            rows.append(None)
            continue
        a, b = cut(a, data_a), cut(b, data_b)
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for high in both:
            groups.append(
                "|".join(",".join(str(i) for i, s, e in side if s >= low and e <= high) for side in (a, b))
            )
            low = high
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        documents.update(set(links))
        rows.append((len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (i, _), n in documents.items():
        highest[i] = max(highest[i], n)
    found = []
    for row in rows:
        if row is None:
            found.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        best = sum(documents[x] == highest[x[0]] for x in links)
        total = sum(documents[x] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((n_a, n_b, len(groups), len(links), best, total, digest))
    return found


TEXTS = [
    "Hello world, this is a test of alignment.",
    "Hello world, this is a test of alignment.",
    " leading space", "trailing space ", "two  spaces   three", " ", "  ", "\n", "a\n\nb \n c\t\td",
    "x \n \n y\r\nz", "nbsp  here 　 wide  em", "a▁b stays out", "▁", "<s> </s> <unk> <0x0A>",
    "<|endoftext|> is text<|endoftext|>", "naïve Übermaß Σίσυφος 中文字 😀👍🏽 İ½²", "é combining",
    "nul\x00byte and \x1c sign \x85 next", "don't we'll I'm they've 12345 3.14159 $$$ !!!",
    "x" * 3000, "ab " * 2000, "ﬁ ligature ｆｕｌｌ", None, "", "if (a) {\r\n  b();\r\n}",
]


def table(spark, texts):
    rows = [(i, t, 7, b"k", f"p{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, row int, keys binary, chunk string")


def got(df):
    return [tuple(r[c] for c in COLUMNS) for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("chunk_bytes, slices, branches", [(1, 7, 2), (2000, 64, 3), (A.CHUNK, 1, 1)])
def test_alignment_equals_a_plain_one(spark, docs, chunk_bytes, slices, branches):
    texts = TEXTS * 2 + [TEXTS[0]] * 30
    df = A.alignment(
        table(spark, texts), FIRST, SECOND,
        chunk_bytes=chunk_bytes, slices=slices, branches=branches,
    )
    assert df.columns == ["doc_id", *COLUMNS]
    assert got(df) == plain(texts)


def test_whole_table_equals_a_plain_one(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    texts = [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]
    short = [t if t is None or len(t) < 4000 else t[:4000] for t in texts]
    assert got(A.alignment(table(spark, short), FIRST, SECOND)) == plain(short)
    assert QUERIES["op12_alignment"](spark, path).count() == len(rows)


def test_null_and_repeated_keys_and_no_rows(spark, docs):
    rows = [(None, "a b"), (None, "a b"), (1, "c d"), (1, "c d"), (2, None)]
    df = docs(rows)
    found = A.alignment(df, FIRST, SECOND).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "None", "None"]
    assert {r["count_sum"] for r in found} == {0, 4}
    assert A.alignment(df.limit(0), FIRST, SECOND).collect() == []
    assert [r["n_a"] for r in A.alignment(docs([(1, None), (2, "")]), FIRST, SECOND).collect()] == [0, 0]


def test_groups_and_links_of_overlapping_tokens():
    """Three pieces, of which the second has no tokens."""
    first, second = np.zeros(10, np.int64), np.zeros(10, np.int64)
    first[[1, 2, 3]] = 2, 3, 1
    second[[7, 8, 9, 5]] = 1, 3, 1, 1
    tokens = A.Tokens.of([([1, 2, 3], [7, 8, 9, 5]), ([], []), ([3], [5])])
    found = A.align(tokens, first, second, with_groups=True)
    assert found.groups == ["1,2|7,8,9;3|5", "", "3|5"]
    pairs = [(int(p) >> 32, int(p) & 0xFFFF) for p in found.pairs]
    assert pairs == [(1, 7), (1, 8), (2, 8), (2, 9), (3, 5), (3, 5)]
    assert found.numbers.tolist() == [[3, 4, 2, 5], [0, 0, 0, 0], [1, 1, 1, 1]]
    assert found.starts.tolist() == [0, 5, 5, 6]
    again = tokens.take(np.array([2, 0]))
    assert A.align(again, first, second, True).groups == ["3|5", "1,2|7,8,9;3|5"]


def test_numbers_are_packed_whole():
    for numbers in ([], [0], [255, 3], [65536, 1], [1 << 40]):
        assert A.unpacked(A.packed(np.array(numbers, np.int64))).tolist() == numbers


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_verified(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    built = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(built.places(keys).tolist()) == list(range(len(keys)))
    assert sum(built.sizes) <= 5 * len(keys) + 64
    table = CountTable.empty(keys)
    assert (table.keys[table.places(keys)] == keys).all()
    with pytest.raises(KeyError):
        table.places(np.array([np.uint64(1) << np.uint64(63)], np.uint64))


def test_pieces_are_encoded_and_written_in_blocks(spark, monkeypatch):
    """The libraries take much memory for a long text, so a chunk's pieces never meet in one."""
    rows = [f" word{i} and{i % 7}, naïve{i}" for i in range(300)]
    pieces = list(dict.fromkeys(p for t in rows for p in A.pieces_of(t)))
    aligner = A.Aligner(FIRST, SECOND)
    sizes, together = [], aligner._together
    monkeypatch.setattr(aligner, "_together", lambda some: sizes.append(len(some)) or together(some))
    monkeypatch.setattr(A, "BLOCK", 64)
    tokens = aligner.tokens(pieces)
    assert len(sizes) > 5 and max(sizes) <= 64
    alone = A.Tokens.of([aligner._one(p) for p in pieces])
    assert all((a == b).all() for a, b in zip(tokens.arrays(), alone.arrays(), strict=True))
    in_blocks = aligner.align(tokens, with_groups=True).groups
    monkeypatch.setattr(A, "BLOCK", 1 << 20)
    assert aligner.align(tokens, with_groups=True).groups == in_blocks
    assert len(in_blocks) == len(pieces)
