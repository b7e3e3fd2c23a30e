"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (runs between white space), weighted by how often
they occur. For every term and sample, three variates drawn from the term's own
hash (two gammas and a uniform) give a value; the term with the least value is
the sample, together with its quantised weight. Two texts have the same sample
with a probability that equals their generalised Jaccard similarity: the sum of
the lesser weights over the sum of the greater ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetlake.llm.tables import partitions
from fleetlake.llm.words import rows_in_pieces

SAMPLES = 128
_POOL_BITS, _NAME_BITS = 16, 12
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_PART, _PORTION = 256, 4096  # terms drawn at once, and terms of a text taken at once


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _order(value: np.ndarray) -> np.ndarray:
    """The 20 leading bits of 32-bit floats, as whole numbers in the floats' order."""
    bits = value.astype(np.float32).view(np.int32)
    return (bits ^ ((bits >> 31) & 0x7FFFFFFF)) >> _NAME_BITS


class Sampler:
    """Signatures of texts by ``samples`` consistent samples each (an even number).

    The variates are a fixed pool of 2**16 triples: a gamma r, the logarithm of
    a gamma c, and a uniform beta. A term's hash names a triple for each sample,
    so drawing costs no logarithm. For weight w and t = floor(ln w / r + beta),
    the value is ln c - r (t - beta + 1). The term and t give the sample's name,
    which also decides between equal values.
    """

    def __init__(self, samples: int, kept: int = 150_000, drawn: int = 16_384):
        self.samples, self.kept, self.drawn = samples, kept, drawn
        numbers = np.arange(5 << _POOL_BITS, dtype=np.uint64).reshape(5, -1)
        mixed = _mix(numbers * _GOLDEN + _GOLDEN) >> np.uint64(11)
        u = (mixed.astype(np.float64) + 0.5) * 2.0**-53
        r = -np.log(u[0] * u[1])
        log_c = np.log(-np.log(u[2] * u[3]))
        self.r, self.log_c, self.beta = (x.astype(np.float32) for x in (r, log_c, u[4]))
        self.once = _order(log_c - r * (1 - u[4]))  # of weight 1, whose t is 0
        self.steps = np.arange(1, samples // 2 + 1, dtype=np.uint64) * _GOLDEN
        # numbers of terms that came in two groups of texts, and of a group's other terms
        self.numbers = np.empty((kept + drawn, samples), np.int32)
        self.place: dict[tuple[str, int], int] = {}
        self.seen: set[int] = set()

    def _draw(self, terms: list[tuple[str, int]]) -> None:
        """For every term and sample one number: the value's order above the name's bits."""
        hashes = np.array([xxh3_64_intdigest(w.encode()) for w, _ in terms], np.uint64)
        weights = np.array([n for _, n in terms], np.float32)
        for k in range(0, len(hashes), _PART):
            part = slice(k, min(k + _PART, len(hashes)))
            # each 64-bit number serves two samples
            mixed = _mix(hashes[part, None] + self.steps).view(np.uint32)
            triple = mixed >> np.uint32(32 - _POOL_BITS)
            name = mixed & np.uint32((1 << _NAME_BITS) - 1)
            order = self.once[triple]
            more = np.flatnonzero(weights[part] > 1)
            if len(more):
                at = triple[more]
                r, beta = self.r[at], self.beta[at]
                t = np.floor(np.log(weights[part][more])[:, None] / r + beta)
                order[more] = _order(self.log_c[at] - r * (t - beta + np.float32(1)))
                renamed = mixed[more] + t.astype(np.uint32) * np.uint32(0x9E3779B1)
                renamed = (renamed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _NAME_BITS)
                name[more] = np.where(t > 0, renamed, name[more])
            into = slice(self.kept + part.start, self.kept + part.stop)
            self.numbers[into] = order << _NAME_BITS | name.view(np.int32)

    def _keep(self, drawn: dict[tuple[str, int], int]) -> None:
        """Keep the terms that an earlier group had too."""
        place, seen = self.place, self.seen
        if len(seen) > 1_000_000:
            seen.clear()
        hashes = list(map(hash, drawn))
        known = [t for t, h in zip(drawn, hashes, strict=True) if h in seen]
        seen.update(hashes)
        if len(place) + len(known) > self.kept:
            place.clear()
        if known:
            at = len(place)
            self.numbers[at : at + len(known)] = self.numbers[[drawn[t] for t in known]]
            place.update(zip(known, range(at, at + len(known)), strict=True))

    def signatures(self, texts: list[str], pairs: Sequence[tuple[int, int]] = ()) -> np.ndarray:
        """For every text one 12-bit number per sample; zeros for a text without words.

        Terms are drawn once for a group of texts that together have at most
        ``drawn`` different ones. ``pairs`` names texts that have much in common, each
        text in one pair at most: what both have is looked up once. It changes no number.
        """
        none = np.iinfo(np.int32).max
        least = np.full((len(texts) + len(pairs), self.samples), none, np.int32)
        group: list[tuple[int, list[int]]] = []
        drawn: dict[tuple[str, int], int] = {}

        def finish() -> None:
            self._draw(list(drawn))
            for i, places in group:
                np.minimum(least[i], self.numbers[places].min(axis=0), out=least[i])
            self._keep(drawn)
            group.clear()
            drawn.clear()

        for i, terms in _terms(texts, pairs):
            for k in range(0, len(terms), _PORTION):
                part = terms[k : k + _PORTION]
                if len(drawn) + len(part) > self.drawn:
                    finish()
                places = list(map(self.place.get, part))
                if None in places:
                    new, kept = drawn.setdefault, self.kept
                    places = [
                        new(t, kept + len(drawn)) if p is None else p
                        for p, t in zip(places, part, strict=True)
                    ]
                group.append((i, places))
        finish()
        for side in zip(*pairs, strict=True):
            each = list(side)
            least[each] = np.minimum(least[each], least[len(texts) :])
        least = least[: len(texts)]
        found = (least & ((1 << _NAME_BITS) - 1)).astype(np.uint16)
        found[least[:, 0] == none] = 0
        return found


def _terms(
    texts: list[str], pairs: Sequence[tuple[int, int]]
) -> Iterator[tuple[int, list[tuple[str, int]]]]:
    """(row, terms): a pair's common terms have a row behind those of the texts."""
    paired: set[int] = set()
    for k, (i, j) in enumerate(pairs, len(texts)):
        one, other = Counter(texts[i].split()), Counter(texts[j].split())
        common, only = [], []
        of_other = other.get
        for term in one.items():
            (common if of_other(term[0]) == term[1] else only).append(term)
        yield k, common
        yield i, only
        of_one = one.get
        yield j, [term for term in other.items() if of_one(term[0]) != term[1]]
        paired.update((i, j))
    for i, text in enumerate(texts):
        if i not in paired:
            yield i, list(Counter(text.split()).items())


@lru_cache(maxsize=2)
def sampler(samples: int) -> Sampler:
    return Sampler(samples)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many characters of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _hex(signature: np.ndarray) -> str:
    return "".join([f"{n:03x}" for n in signature.tolist()])


def fingerprints(
    docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint): three hex digits per sample, of each row's text where it is read.

    A null text counts as empty; a text without words has zeros. Null keys,
    repeated rows and other columns make no difference; an empty table gives an
    empty one.
    """
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = sampler(samples).signatures
        for batch in rows_in_pieces(batches):
            made = [_hex(s) for s in sign(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(made, pa.string())], ["key", "fingerprint"]
            )

    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def _in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows by falling key in buckets, each ended by a guest: the row that follows its last one.

    Buckets are cut at quantiles of the keys, so that no task holds the whole
    order. The cuts and the buckets' first keys are at most eight per partition.
    """
    parts = partitions(docs.sparkSession)
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = ", ".join(f"{i / (8 * parts)!r}D" for i in range(1, 8 * parts))
    found = slim.agg(F.expr(f"percentile_approx(key, array({shares}), {80 * parts})")).first()[0]
    cuts = sorted({float(c) for c in found or [0.0]})
    splits = [float("-inf"), *cuts, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="number", outputCol="up", handleInvalid="keep")
    numbered = slim.withColumn("number", F.coalesce(F.col("key").cast("double"), F.lit(splits[0])))
    # falling, and null keys behind all others
    bucket = F.when(F.col("key").isNull(), F.lit(1)).otherwise(-F.col("up").cast("int"))
    placed = cutter.transform(numbered).select("key", "text", bucket.alias("bucket"))
    found = placed.groupBy("bucket").agg(F.max("key").alias("first")).collect()
    firsts = {r["bucket"]: r["first"] for r in found}
    order = sorted(firsts)
    # the first row of each bucket is the guest of the one before it, and of the last one
    of = [(order[i - 1], firsts[b], b) for i, b in enumerate(order)]
    kind = slim.schema["key"].dataType
    schema = f"target int, first {kind.simpleString()}, bucket int"
    wanted = docs.sparkSession.createDataFrame(of, schema)
    guests = (
        placed.join(F.broadcast(wanted), "bucket")
        .where(F.col("key").eqNullSafe(F.col("first")))
        .groupBy("target")
        .agg(F.min("text").alias("text"))
        .select(
            F.lit(None).cast(kind).alias("key"),
            "text",
            F.col("target").alias("bucket"),
            F.lit(True).alias("guest"),
        )
    )
    return (
        placed.withColumn("guest", F.lit(False))
        .unionByName(guests)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("key"), "text")
    )


def edit_likeness(
    docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (shares of equal samples). The edited text takes
    its end from the next row by falling key (null keys last, rows of one key
    by text, the first row after the last). A null text counts as empty; two
    texts without words are alike, and unlike all others. An empty table gives
    an empty one. Texts are shuffled once. Keys are numbers that few rows share:
    the rows of one key are sorted in one task.
    """
    ordered = _in_order(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = sampler(samples).signatures
        waiting = None  # the last row, whose next one has not come yet: key, text, signature
        for batch in rows_in_pieces(batches, 128):
            texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
            guest = batch.column("guest").to_pylist()
            before = [waiting, *((keys[i], texts[i], None) for i in range(len(texts) - 1))]
            follows = [waiting is not None, *(not g for g in guest[:-1])]
            changed = [
                edited(b[1], t) if f else "" for b, f, t in zip(before, follows, texts, strict=True)
            ]
            # an edited text begins as the text before it does
            pairs = [(i - 1, len(texts) + i) for i in range(1, len(texts)) if follows[i]]
            signed = sign(texts + changed, pairs)
            own, other = signed[: len(texts)], signed[len(texts) :]
            done = []
            for i, follow in enumerate(follows):
                if follow:
                    k, text_before, mine = before[i]
                    mine = own[i - 1] if i else mine
                    done.append(
                        (
                            k,
                            len(text_before),
                            sha256(changed[i].encode()).hexdigest(),
                            _hex(mine),
                            _hex(other[i]),
                            float((mine == other[i]).mean()),
                            float((mine == own[i]).mean()),
                        )
                    )
            waiting = None if guest[-1] else (keys[-1], texts[-1], own[-1])
            columns = list(zip(*done, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, kind)
                    for c, kind in zip(columns, kinds(batch.column("key").type), strict=True)
                ],
                names,
            )

    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def kinds(key_type: pa.DataType) -> list[pa.DataType]:
        return [key_type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]

    kind = ordered.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return ordered.mapInArrow(run, schema).withColumnRenamed("key", key)
