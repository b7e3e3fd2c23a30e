"""Token counts, encoding and packing against the libraries of the vocabularies."""

import random
import struct
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetlake.llm import bpe, bpe_automaton, packing, token_counts, words

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = (
    "a b the ing inǵ \x1c \x85 \xa0 é ß Σ ΑΣ İ ½ ² Ⅳ 一 😀 's ' <|endoftext|> <|startoftext|> "
    "<| 1 23 _ %%% aaaa eeeee hahahaha !!!!!!!! ...... 中文"
).split(" ") + [" ", "\n", "  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def pack_ids(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=25).map("".join)))
def test_any_text(text):
    lib = Tokenizer.from_file(WORDS) if not hasattr(test_any_text, "lib") else test_any_text.lib
    test_any_text.lib = lib
    ids = lib.encode(text, add_special_tokens=False).ids
    assert token_counts.counter(WORDS)(text) == len(ids)
    packed, decoded = bpe_automaton.coder(WORDS)(text)
    assert packed == pack_ids(ids)
    assert decoded == lib.decode(ids, skip_special_tokens=False)


def test_words_of_the_vocabulary(library):
    """Joined vocabulary strings make the hardest words: many merges compete."""
    rng = random.Random(3)
    vocabulary = [w.removesuffix("</w>") for w in library.get_vocab() if w.isascii()]
    count, code = token_counts.counter(WORDS), bpe_automaton.coder(WORDS)
    for _ in range(4000):
        text = "".join(rng.choices(vocabulary, k=rng.randint(1, 8)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert count(text) == len(ids) and code(text)[0] == pack_ids(ids)


def test_arcs_are_what_merging_leaves_side_by_side():
    """Two symbols may follow each other just if merging their spellings gives these two."""
    merges = bpe.load(WORDS)
    automaton = bpe_automaton.Automaton(merges)
    rng = random.Random(5)
    made = [w for (_, w) in merges.pairs.values() if not merges.labels[w].endswith("</w>")]
    whole = [w for (_, w) in merges.pairs.values() if merges.labels[w].endswith("</w>")]
    lib = Tokenizer.from_file(WORDS)
    back = {c: b for b, c in enumerate(words.byte_characters())}
    for _ in range(1500):
        a, b = rng.choice(made), rng.choice(whole)
        spelled = merges.labels[a] + merges.labels[b].removesuffix("</w>")
        try:
            word = bytes(back[c] for c in spelled).decode()
        except UnicodeDecodeError:
            continue
        if words.splitter(words.LOWER_WORDS)(words.lower_normal(word)) != [word]:
            continue
        assert automaton.arc(a, b) == (lib.encode(word, add_special_tokens=False).ids == [a, b])


def test_memo_is_bounded():
    made = []
    memo = words.Memo(lambda w: made.append(w) or len(w), limit=10, longest=5)
    for n in range(100):
        assert memo[str(n)] == len(str(n)) and len(memo) <= 10
    assert memo["a long word"] == 11 and "a long word" not in memo


def test_counts_and_codes_of_awkward_rows(docs, awkward, library):
    got = token_counts.token_counts(docs(awkward), WORDS, limit=2048).collect()
    coded = bpe_automaton.bpe_digests(docs(awkward), WORDS).collect()
    full = bpe_automaton.bpe_round(docs(awkward), WORDS).collect()
    expected, expected_codes, expected_full = Counter(), Counter(), Counter()
    for key, text in awkward:
        text = text or ""
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[key, len(text.encode()), len(ids), len(ids) > 2048] += 1
        digests = sha256(pack_ids(ids)).hexdigest(), sha256(decoded.encode()).hexdigest()
        expected_codes[(key, len(ids), *digests)] += 1
        expected_full[key, pack_ids(ids), decoded] += 1
    assert Counter(map(tuple, got)) == expected
    assert Counter(map(tuple, coded)) == expected_codes
    assert Counter((r[0], bytes(r[1]), r[2]) for r in full) == expected_full
    assert any(r["over_limit"] for r in got)
    assert token_counts.token_counts(docs([]), WORDS, 2048).collect() == []
    assert bpe_automaton.bpe_digests(docs([]), WORDS).collect() == []


def check_packing(rows, got, size):
    """Every id in one piece, sequences gapless; returns the padding."""
    lib = Tokenizer.from_file(BYTES)
    left = Counter()
    of = defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
    for key, text in rows:
        left[key] += len(lib.encode(text or "", add_special_tokens=False).ids) + 1
    assert Counter({k: sum(r["length"] for r in rs) for k, rs in of.items()}) == left
    unique = {key: text for key, text in rows if [k for k, _ in rows].count(key) == 1}
    for key, text in unique.items():
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(of[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing_of_awkward_rows(docs, awkward):
    got = packing.pack(docs(awkward), BYTES).collect()
    assert check_packing(awkward, got, 1024) == 0
    assert packing.pack(docs([]), BYTES).collect() == []


def test_packing_of_many_rows(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "of", "ing", "réeux"], k=rng.randint(0, 90)))) for i in range(900)]
    got = packing.pack(docs(rows), BYTES, size=64).collect()
    assert check_packing(rows, got, 64) == 0


def test_packing_when_most_documents_have_one_length(docs):
    """Every pattern has a gap, which pieces of other documents fill."""
    rows = [(i, " the" * 599) for i in range(300)]
    got = packing.pack(docs(rows), BYTES).collect()
    assert check_packing(rows, got, 1024) == 0
    cut = Counter(r["doc_id"] for r in got)
    assert sum(n == 1 for n in cut.values()) > 150


def test_columns_reach_the_bound():
    """The linear program against the known best: pairs that fill a sequence."""
    lengths, demand = np.array([300, 400, 624, 724]), np.array([50.0, 70.0, 70.0, 50.0])
    patterns, use, floor = packing.solve(lengths, demand, 1024, 1e-9, 0)
    assert abs(use.sum() - 120) < 0.01 and abs(floor - 120) < 0.01
    assert ((patterns @ use) >= demand - 1e-6).all()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_layout_deals_every_rank_once(counts):
    layout = packing.lay_out(counts, 32, 0.001, 0)
    ranks = Counter()
    filled = Counter()
    for length, low, high, each, sequence, offset, place in layout.rows:
        for rank in range(low, high):
            ranks[length, rank] += 1
            if sequence >= 0:
                k = rank - low
                filled[sequence + k // each] += length
            else:
                cuts = packing.stream_cuts(place + (rank - low) * length, length, layout, 32)
                assert sum(c[1] for c in cuts) == length
                for _, n, number, _ in cuts:
                    filled[number] += n
    assert ranks == Counter({(n, r): 1 for n, c in counts.items() for r in range(c)})
    assert sum(filled.values()) == sum(n * c for n, c in counts.items())
    assert all(n == 32 or n & (n - 1) == 0 for n in filled.values())


def test_patterns_place_most_tails():
    """A wide histogram: the program ends near its bound, and over 0.9 of the tails are whole."""
    rng = random.Random(3)
    counts = Counter(min(1023, max(1, int(rng.expovariate(1 / 400)))) for _ in range(20000))
    lengths = np.array(sorted(counts))
    demand = np.array([counts[n] for n in lengths.tolist()], float)
    patterns, use, floor = packing.solve(lengths, demand, 1024, 0.0003, 3)
    assert (lengths @ patterns <= 1024).all()
    assert np.abs(patterns @ use - demand).max() < 1e-5 * demand.max() + 1e-6
    assert floor - 1e-9 <= use.sum() <= floor * 1.001
    layout = packing.lay_out(dict(counts), 1024, 0.0003)
    placed = sum(r[2] - r[1] for r in layout.rows if r[4] >= 0)
    assert placed > 0.9 * sum(counts.values())
    assert layout.stream >= layout.gap_tokens


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.floats(0.01, 1)), min_size=1, max_size=6))
def test_pricing_is_exact(items):
    lengths = np.array(sorted({n for n, _ in items}))
    worth = np.array([w for _, w in items][: len(lengths)])
    values, last = packing.best_values(lengths, worth, 40)
    value, pattern = values[40], packing.pattern_of(lengths, last, 40)
    best = [0.0] * 41
    for c in range(1, 41):
        best[c] = max([best[c - 1], *(best[c - n] + w for n, w in zip(lengths, worth, strict=True) if n <= c)])
    assert abs(value - best[40]) < 1e-9
    assert lengths @ pattern <= 40 and abs(worth @ pattern - value) < 1e-9
