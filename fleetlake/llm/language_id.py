"""Language of texts, by a bidirectional gated recurrent network over their bytes.

A text is read in windows of ``WINDOW`` bytes. In each, one network reads the
bytes forwards and one backwards; both states together label every byte with a
probability for each language. A text's probabilities are the means over all of
its bytes, so whole texts count, and a long one is many windows of a batch. The network is
trained in numpy, by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.words import rows_in_pieces

WINDOW = 96  # bytes
HIDDEN = 12  # states of each direction
SAMPLE = 512  # texts that are learnt from, per language at most
CUTS = 6  # windows that are taken from each of them
STEPS = 400
BATCH = 128
PAD = 256  # the symbol of places beyond a text's end
UNDETERMINED = "und"
_BESIDE = 4096  # windows that are read at once
_letter = regex.compile(r"\p{L}").search


@dataclass(frozen=True)
class Network:
    """Weights; the first axis is the direction, gates are in the order update, reset, new.

    ``symbols`` are the gates' inputs by byte (257 rows), ``states`` the gates'
    inputs by state, ``labels`` the languages' by state, ``bias`` theirs alone.
    """

    languages: tuple[str, ...]
    symbols: np.ndarray
    states: np.ndarray
    labels: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.symbols, self.states, self.labels, self.bias]


def start(languages: tuple[str, ...], hidden: int, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    symbols = rng.normal(0, 0.3, (2, 257, 3 * hidden))
    states = rng.normal(0, hidden**-0.5, (2, hidden, 3 * hidden))
    labels = rng.normal(0, hidden**-0.5, (2, hidden, len(languages)))
    arrays = (symbols, states, labels, np.zeros(len(languages)))
    return hold_at_pad(Network(languages, *(a.astype(np.float32) for a in arrays)))


def hold_at_pad(network: Network) -> Network:
    """Beyond a text's end the update gate is saturated, so that the state stays as it is."""
    hidden = network.states.shape[1]
    network.symbols[:, PAD] = 0
    network.symbols[:, PAD, :hidden] = 40
    return network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _both_ways(places: np.ndarray) -> np.ndarray:
    """(time, direction, window): the symbols as each direction meets them."""
    return np.stack((places.T, places.T[::-1]), axis=1)


def read(network: Network, places: np.ndarray) -> np.ndarray:
    """(time, window, language): the probabilities at every place of windows of symbols.

    Windows are the last axis inside, so that each gate is one line of memory. The inputs of
    gates are halved beforehand, as sigmoid(x) = (1 + tanh(x / 2)) / 2.
    """
    hidden, (count, length) = network.states.shape[1], places.shape
    half = np.ones(3 * hidden, np.float32)
    half[: 2 * hidden] = 0.5
    symbols = np.ascontiguousarray((network.symbols * half).transpose(0, 2, 1))
    across = np.concatenate((network.states * half, network.labels), axis=2)
    across = np.ascontiguousarray(across.transpose(0, 2, 1))
    at = np.ascontiguousarray(places.T).astype(np.intp)
    state = np.zeros((2, hidden, count), np.float32)
    given = np.empty((2, 3 * hidden, count), np.float32)
    moved = np.empty((2, across.shape[1], count), np.float32)
    gates, new = np.empty((2, 2 * hidden, count), np.float32), np.empty_like(state)
    update, reset = gates[:, :hidden], gates[:, hidden:]
    found = np.empty((length, 2, len(network.languages), count), np.float32)
    for t in range(length):
        np.matmul(across, state, out=moved)
        if t:
            found[t - 1] = moved[:, 3 * hidden :]
        symbols[0].take(at[t], axis=1, out=given[0], mode="clip")
        symbols[1].take(at[length - 1 - t], axis=1, out=given[1], mode="clip")
        np.add(given[:, : 2 * hidden], moved[:, : 2 * hidden], out=gates)
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        np.multiply(reset, moved[:, 2 * hidden : 3 * hidden], out=new)
        new += given[:, 2 * hidden :]
        np.tanh(new, out=new)
        state -= new
        state *= update
        state += new
    found[length - 1] = network.labels.transpose(0, 2, 1) @ state
    logits = found[:, 0] + found[::-1, 1] + network.bias[:, None]
    return softmax(logits, 1).transpose(0, 2, 1)


def softmax(logits: np.ndarray, axis: int = -1) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=axis, keepdims=True))
    return raised / raised.sum(axis=axis, keepdims=True)


def loss_and_slopes(
    network: Network, places: np.ndarray, target: np.ndarray
) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes, and its derivative by every weight.

    ``target`` is the language's number of each window. Places beyond a text's
    end have no loss; their symbol's weights are fixed.
    """
    symbols, states, labels, bias = network.arrays()
    hidden, (count, length) = states.shape[1], places.shape
    met = _both_ways(places)
    ways = np.arange(2)[:, None]
    state = np.zeros((length + 1, 2, count, hidden), symbols.dtype)
    gates = np.empty((length, 2, count, 2 * hidden), symbols.dtype)
    new, from_state = np.empty_like(state[1:]), np.empty_like(state[1:])
    for t in range(length):
        given = symbols[ways, met[t]]
        moved = state[t] @ states
        gates[t] = _sigmoid(given[..., : 2 * hidden] + moved[..., : 2 * hidden])
        from_state[t] = moved[..., 2 * hidden :]
        new[t] = np.tanh(given[..., 2 * hidden :] + gates[t, ..., hidden:] * from_state[t])
        state[t + 1] = new[t] + gates[t, ..., :hidden] * (state[t] - new[t])
    out = state[1:]
    found = softmax(out[:, 0] @ labels[0] + out[::-1, 1] @ labels[1] + bias)
    real = (places != PAD).T
    total = max(1, int(real.sum()))
    right = found[:, np.arange(count), target]
    loss = float(-(np.log(np.maximum(right, 1e-30)) * real).sum() / total)

    error = found
    error[:, np.arange(count), target] -= 1
    error *= (real / total)[:, :, None]
    by_way = np.stack((error, error[::-1]), axis=1)  # as each direction meets it
    slope_symbols, slope_states = np.zeros_like(symbols), np.zeros_like(states)
    slope_labels = np.einsum("tdbh,tdbc->dhc", out, by_way, optimize=True)
    to_state = np.zeros((2, count, hidden), symbols.dtype)
    turned, labels_turned = states.transpose(0, 2, 1), labels.transpose(0, 2, 1)
    inputs = np.empty((length, 2, count, 3 * hidden), symbols.dtype)
    for t in range(length - 1, -1, -1):
        to_state = to_state + by_way[t] @ labels_turned
        update, reset = gates[t, ..., :hidden], gates[t, ..., hidden:]
        at_new = to_state * (1 - update) * (1 - new[t] ** 2)
        at_update = to_state * (state[t] - new[t]) * update * (1 - update)
        at_reset = at_new * from_state[t] * reset * (1 - reset)
        inputs[t] = np.concatenate((at_update, at_reset, at_new), axis=2)
        onward = np.concatenate((at_update, at_reset, at_new * reset), axis=2)
        slope_states += state[t].transpose(0, 2, 1) @ onward
        to_state = to_state * update + onward @ turned
    for way in range(2):
        of_symbol = met[:, way].ravel()
        order = np.argsort(of_symbol, kind="stable")
        sorted_, rows = of_symbol[order], inputs[:, way].reshape(-1, 3 * hidden)[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        slope_symbols[way, sorted_[first]] = np.add.reduceat(rows, first, axis=0)
    slope_symbols[:, PAD] = 0
    return loss, [slope_symbols, slope_states, slope_labels, error.sum(axis=(0, 1))]


def train(
    windows: list[bytes],
    target: list[str],
    hidden: int = HIDDEN,
    steps: int = STEPS,
    batch: int = BATCH,
    length: int = WINDOW,
    seed: int = 0,
) -> Network:
    """A network fitted to windows of at most ``length`` bytes and their languages, on the driver.

    Steps with momentum and scaling (Adam) on batches with equally many windows of
    each language on average. Equal windows give an equal network.
    """
    languages = tuple(sorted(set(target)))
    network = start(languages, hidden, seed)
    if len(languages) < 2:
        return network
    places = as_places(windows, length)
    number = np.array([languages.index(t) for t in target])
    chance = 1 / np.bincount(number)[number]
    chance /= chance.sum()
    rng = np.random.default_rng(seed)
    arrays = network.arrays()
    mean, square = ([np.zeros_like(a) for a in arrays] for _ in range(2))
    for step in range(1, steps + 1):
        some = rng.choice(len(places), batch, p=chance)
        _, slopes = loss_and_slopes(network, places[some], number[some])
        size = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        rate = 0.02 * min(1, step / 20, 2 * (1 - step / (steps + 1)))
        for a, s, m, q in zip(arrays, slopes, mean, square, strict=True):
            s = s * min(1, 1 / max(size, 1e-9))  # long windows may give steep slopes
            m += 0.1 * (s - m)
            q += 0.01 * (s**2 - q)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-8)
        hold_at_pad(network)
    return network


def as_places(texts: list[bytes], length: int) -> np.ndarray:
    """Texts of at most ``length`` bytes as rows of symbols."""
    places = np.full((len(texts), length), PAD, np.int16)
    for row, text in zip(places, texts, strict=True):
        row[: len(text)] = np.frombuffer(text, np.uint8)
    return places


def probabilities(network: Network, texts: list[bytes], length: int = WINDOW) -> np.ndarray:
    """(text, language): means over all bytes of each text; zeros for an empty one."""
    sizes = np.array([len(t) for t in texts], np.int64)
    windows = -(-sizes // length)
    found = np.zeros((len(texts), len(network.languages)))
    flat = np.full((int(windows.sum()), length), PAD, np.int16)
    first = np.concatenate(([0], np.cumsum(windows)[:-1])) * length
    line = flat.reshape(-1)
    for text, at in zip(texts, first.tolist(), strict=True):
        line[at : at + len(text)] = np.frombuffer(text, np.uint8)
    of = np.repeat(np.arange(len(texts)), windows)
    for k in range(0, len(flat), _BESIDE):
        part = flat[k : k + _BESIDE]
        at_places = read(network, part)
        at_places *= (part != PAD).T[:, :, None]
        np.add.at(found, of[k : k + _BESIDE], at_places.sum(axis=0, dtype=np.float64))
    return found / np.maximum(sizes, 1)[:, None]


def held_out(key: str) -> Column:
    """Whether a row's key, as text, has a check sum that leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_windows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    cuts: int = CUTS,
    length: int = WINDOW,
) -> tuple[list[bytes], list[str]]:
    """Windows of at most ``sample`` texts per language that are not held out, with the language.

    Texts are drawn by the hash of key and text; each gives ``cuts`` windows at
    places that the hash says. Equal texts with equal windows count once.
    """
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("binary").alias("text"),
        F.xxhash64(key, text).alias("hash"),
        held_out(key).alias("held_out"),
    ).where("NOT held_out AND lang IS NOT NULL AND octet_length(text) > 0")
    # a row per language; copies of a text count once, or they would crowd out the others
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()
    # twice as many as needed pass on average, so that the window below sorts few of them
    share = F.lit(0.0)
    for row in counted:
        of = 1.0 if row["n"] <= 4 * sample + 100 else 2 * sample / row["n"]
        share = F.when(F.col("lang") == row["lang"], of).otherwise(share)
    drawn = rows.where(F.expr("pmod(hash, 1000003)") < share * 1000003)
    begin = "pmod(xxhash64(hash, {}), greatest(octet_length(text) - {}, 0) + 1)"
    parts = [
        F.expr(f"substring(text, int({begin.format(i, length)}) + 1, {length})")
        for i in range(cuts)
    ]
    slim = drawn.select("lang", "hash", F.array(*parts).alias("windows"))
    one_each = slim.groupBy("lang", "hash").agg(F.first("windows").alias("windows"))
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = one_each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)
    found = chosen.orderBy("lang", "place").select("lang", "windows").collect()
    windows = [bytes(w) for row in found for w in row["windows"]]
    return windows, [row["lang"] for row in found for _ in row["windows"]]


def label_languages(
    docs: DataFrame,
    network: Network,
    key: str = "doc_id",
    text: str = "text",
    length: int = WINDOW,
) -> DataFrame:
    """(key, held_out, lang_pred, score) of every row, by a trained network."""
    rows = docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches):
            texts = batch.column("text").to_pylist()
            known = [bool(network.languages and t and _letter(t)) for t in texts]
            shares = probabilities(
                network, [t.encode() if k else b"" for t, k in zip(texts, known, strict=True)], length
            )
            best = shares.argmax(axis=1) if network.languages else np.zeros(len(texts), int)
            names = [
                network.languages[b] if k else UNDETERMINED
                for b, k in zip(best.tolist(), known, strict=True)
            ]
            score = shares.max(axis=1, initial=0).clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                ["key", "held_out", "lang_pred", "score"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def language_id(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    steps: int = STEPS,
) -> DataFrame:
    """(key, held_out, lang_pred, score) of every row.

    The network learns from at most ``sample`` texts per language, of rows that
    are not held out and have a language; every row's whole text is labelled where it is read. Null
    texts and those without a letter are ``und`` with a score of 0, and so is everything
    if no row has a language; with one language only, that one is predicted.
    A null key is not held out. Equal texts have equal predictions; repeated
    rows stay, an empty table gives an empty one, other columns are not looked at.
    """
    network = train(*labelled_windows(docs, key, text, lang, sample), steps=steps)
    return label_languages(docs, network, key, text)
