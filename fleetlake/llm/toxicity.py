"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

P(grade >= j) = sigmoid(w.x - theta_j), with one weight vector for all grades
and rising thresholds. The severity of a text is its expected grade, the sum of
these probabilities. Features are the words and word beginnings that a text has,
however often, so that a mark weighs as much in a long text as in a short one. The severity from
which texts are rejected is read from labelled texts that a model has not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetlake.llm.tables import stored

GRADES = 3  # above 0, the grade of a text that is not toxic
SAMPLE = 4000  # labelled texts that a model is fitted on, at most
LONGEST = 1 << 15  # bytes of a text of that sample, so that it fits into the driver's memory
CLEAN = 0.97  # share of unseen clean texts that are left alone
STEM = 5  # characters of a word's beginning
SIGNIFICANT = 3.0  # standard errors that a word's log odds of the two labels must differ by
RARE = 0.1  # the share that a rarer label has in the sample and in the fit, at least
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Weights by word, and a threshold per grade; without weights, every severity is zero."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, text: str | None) -> float:
        if not self.thresholds:
            return 0.0
        # in the order of the words, so that equal sets of words give equal sums
        known = sorted(self.weights.keys() & features(text or ""))
        score = sum([self.weights[w] for w in known])
        return sum([1 / (1 + exp(t - score)) for t in self.thresholds])


def features(text: str) -> set[str]:
    """The different words of a text, and the first characters of its longer words, marked."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:STEM]}~" for w in words if len(w) > STEM}


def _per_label(labelled: DataFrame, name: str, rows: int) -> DataFrame:
    """At most ``rows`` rows by the hash of their name, a tenth or more of the rarer label's.

    Otherwise labels have their own shares, and what one label lacks the other gets.
    """
    counts = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    total = max(1, sum(counts.values()))
    found = []
    for toxic, count in counts.items():
        share = min(max(count / total, RARE), 1 - RARE)
        others = total - count
        most = max(round(rows * share), rows - others)
        some = labelled.where(F.col("toxic") == toxic)
        found.append(some.orderBy(F.xxhash64(name), name).limit(most))
    if not found:
        return labelled
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    rows: int,
    key: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
) -> pd.DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, by the hash of their key per label.

    Each different text comes once; texts with both labels count as toxic. Texts
    of over ``longest`` bytes are left out of the sample (all texts are scored).
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col("toxic").cast("int").alias("toxic"))
        .where("key IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("key")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = _per_label(stored(known), "key", rows)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # at most `rows` keys and labels are broadcast
    found = texts.where(F.octet_length("text") <= longest).join(F.broadcast(chosen), "key")
    found = found.groupBy("text").agg(F.max("toxic").alias("toxic"))
    # keys that many rows share could bring more texts than keys
    sample = _per_label(stored(found), "text", rows)
    return sample.orderBy(F.xxhash64("text"), "text").toPandas()


def numbered(
    texts: Iterable[str], number: dict[str, int], found: list[np.ndarray]
) -> Iterator[set[str]]:
    """The features of each text, which are also put into ``found`` as numbers.

    Sets of words take the driver over ten times the memory of the numbers, so one is held at a time.
    """
    for text in texts:
        words = features(text)
        numbers = (number.setdefault(w, len(number)) for w in words)
        found.append(np.fromiter(numbers, np.int32, len(words)))
        yield words


def one_each(found: Iterable[set[str]], toxic: np.ndarray) -> list[tuple[int, int]]:
    """(place, label) of one text of each family of near copies, with most of its labels.

    Families would teach their own words. Each text has 16 least hashes of its
    words; it belongs to the first text that it shares eight or more with.
    """
    rng = np.random.default_rng(0)
    factors = rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    first_of: dict[tuple[int, int], list[int]] = {}
    labels: dict[int, list[int]] = {}
    for i, words in enumerate(found):
        hashes = np.array([xxh3_64_intdigest(w) for w in words] or [0], np.uint64)
        least = list(enumerate((hashes[:, None] * factors).min(axis=0).tolist()))
        shared = Counter(j for one in least for j in first_of.get(one, ()))
        family = min((j for j, n in shared.items() if n >= 8), default=i)
        labels.setdefault(family, []).append(int(toxic[i]))
        if family == i:
            for one in least:
                first_of.setdefault(one, []).append(i)
    return [(i, int(2 * sum(given) >= len(given))) for i, given in labels.items()]


def grade(found: list[np.ndarray], toxic: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Grades of labelled texts: 0 without the label, else by thirds of what tells them apart.

    Labelled texts are ranked by how many telling words of toxic texts (those with a
    positive difference in log odds) they have; those with none have the lowest grade.
    ``marks`` tells by a word's number whether it is one.
    """
    amount = np.array([marks[words].sum() for words in found])
    some = amount[(toxic == 1) & (amount > 0)]
    cuts = np.quantile(some, np.arange(1, GRADES) / GRADES) if len(some) else np.zeros(GRADES - 1)
    return np.where(toxic == 1, 1 + (amount[:, None] > cuts).sum(axis=1), 0)


def tell_apart(
    found: list[np.ndarray],
    toxic: np.ndarray,
    number: dict[str, int],
    least: float,
    significant: float,
) -> dict[str, float]:
    """Words that tell the labels apart, with the difference of their log odds.

    They are in at least ten texts of one label and a share ``least`` of them (of a label
    with few texts a quarter, three at least, is enough), so that
    single documents aren't learnt by heart, and differ by ``significant`` standard errors.
    """
    totals = [int((toxic == k).sum()) for k in (0, 1)]
    counts = np.zeros((2, len(number)), np.int64)
    for words, k in zip(found, toxic.tolist(), strict=True):
        counts[k, words] += 1  # a text has a word once
    floors = [max(int(least * n), min(10, max(3, n // 4))) for n in totals]
    enough = (counts >= np.array(floors)[:, None]).any(axis=0)
    words = sorted(w for w, i in number.items() if enough[i])
    have = counts[:, [number[w] for w in words]] + 0.5
    lack = np.array(totals)[:, None] + 1 - have
    difference = np.diff(np.log(have / lack), axis=0)[0]
    errors = np.sqrt((1 / have + 1 / lack).sum(axis=0))
    return {
        w: d
        for w, d, e in zip(words, difference.tolist(), errors.tolist(), strict=True)
        if abs(d) >= significant * e
    }


def loss_and_slopes(
    score: np.ndarray, thresholds: np.ndarray, grades: np.ndarray, weight: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of ordered grades, and its derivatives by scores and thresholds.

    P(grade = j) is sigmoid(theta_(j+1) - score) - sigmoid(theta_j - score), where the lowest
    grade has no lower and the highest no upper threshold.
    """
    bounds = np.concatenate(([-np.inf], thresholds, [np.inf]))
    with np.errstate(over="ignore"):
        below, above = (1 / (1 + np.exp(score - bounds[grades + k])) for k in (0, 1))
    chance = np.maximum(above - below, 1e-12)
    at_below, at_above = below * (1 - below), above * (1 - above)
    by_score = weight * (at_above - at_below) / chance
    by_bound = np.bincount(grades, weight * at_below / chance, minlength=len(bounds))
    by_bound += np.bincount(grades + 1, -weight * at_above / chance, minlength=len(bounds))
    return float(-(weight * np.log(chance)).sum()), by_score, by_bound[1:-1]


def fit(
    sample: pd.DataFrame,
    least: float = 0.01,
    steps: int = 300,
    decay: float = 1e-3,
    significant: float = SIGNIFICANT,
) -> Model:
    """Fit weights and thresholds on a bounded sample (columns text and toxic), on the driver.

    Words are those that tell the labels apart. A rarer label weighs as if it had a
    tenth of the texts. The likelihood of the ordered grades is raised by gradient steps with
    momentum and scaling (Adam); the thresholds are kept in order by fitting
    their differences' logarithms. Without texts of both kinds there is nothing to fit.
    """
    toxic = sample["toxic"].to_numpy(int) if len(sample) else np.zeros(0, int)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return Model({}, ())
    number: dict[str, int] = {}
    found: list[np.ndarray] = []
    families = one_each(numbered(sample["text"], number, found), toxic)
    found = [found[i] for i, _ in families]
    toxic = np.array([label for _, label in families])
    totals = [int((toxic == k).sum()) for k in (0, 1)]
    if not min(totals):
        return Model({}, ())
    telling = tell_apart(found, toxic, number, least, significant)
    vocabulary = sorted(telling)
    marks, place = np.zeros(len(number), bool), np.full(len(number), -1)
    for i, w in enumerate(vocabulary):
        marks[number[w]], place[number[w]] = telling[w] > 0, i
    grades = grade(found, toxic, marks)
    shares = np.array(totals) / len(found)
    weight = (np.clip(shares, RARE, 1 - RARE) / shares)[toxic]
    weight /= weight.sum()
    places = [np.sort(place[words]) for words in found]
    places = [p[np.searchsorted(p, 0) :] for p in places]
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    column = np.concatenate(places)
    n, m = len(found), len(vocabulary)
    share = (weight[:, None] * (grades[:, None] >= np.arange(1, GRADES + 1))).sum(axis=0)
    start = np.log((1 - share + 1e-3) / (share + 1e-3))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    parameters = np.concatenate((np.zeros(m), start[:1], gaps))
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        weights, gaps = parameters[:m], np.exp(parameters[m + 1 :])
        thresholds = np.cumsum(np.concatenate((parameters[m : m + 1], gaps)))
        score = np.bincount(row, weights[column], minlength=n)
        _, by_score, by_threshold = loss_and_slopes(score, thresholds, grades, weight)
        slope = np.bincount(column, by_score[row], minlength=m) + decay * weights
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate((slope, tail[:1], tail[1:] * gaps))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * min(1, 3 * (1 - step / (steps + 1)))
        parameters -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    thresholds = np.cumsum(np.concatenate((parameters[m : m + 1], np.exp(parameters[m + 1 :]))))
    weights = {w: float(x) for w, x in zip(vocabulary, parameters[:m], strict=True) if x}
    return Model(weights, tuple(map(float, thresholds)))


def cut_off(sample: pd.DataFrame, clean: float = CLEAN) -> float:
    """The severity that parts the labels of unseen texts best, and leaves ``clean`` of the clean alone.

    Each half of the sample, by the hash of the text, is scored by a model of the other
    half. Of the severities that leave enough clean texts alone, the one with the highest sum of
    shares (toxic texts from it on, clean ones below) is taken, in the middle between
    it and the next lower one. Without texts of both labels in both halves, it is half a grade.
    """
    if not len(sample):
        return 0.5
    half = np.array([xxh3_64_intdigest(t) & 1 for t in sample["text"]])
    toxic, scores = sample["toxic"].to_numpy() == 1, np.zeros(len(sample))
    for k in (0, 1):
        model = fit(sample[half != k])
        if not model.thresholds:
            return 0.5
        scores[half == k] = [model.severity(t) for t in sample["text"][half == k]]
    levels = np.unique(scores)
    caught = 1 - np.searchsorted(np.sort(scores[toxic]), levels) / toxic.sum()
    alone = np.searchsorted(np.sort(scores[~toxic]), levels) / (~toxic).sum()
    enough = np.flatnonzero((alone >= clean) & (caught > 0))
    if not len(enough) or enough[0] == 0:
        return 0.5
    # of equal sums the highest level
    best = enough[::-1][(caught + alone)[enough[::-1]].argmax()]
    return float((levels[best] + levels[best - 1]) / 2)


def severity(model: Model, text: Column) -> Column:
    """The expected grade of a text; of null as of an empty text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.severity(t) for t in texts], dtype="float64")

    return score(text)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    reject_from: float | None = None,
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
) -> DataFrame:
    """(key, severity, rejected) of every row; rejected from a severity of ``reject_from``.

    If that is not given, it is read from labelled texts by ``cut_off``.
    The model is fitted on at most ``sample`` labelled texts of at most
    ``longest`` bytes; every row is scored where it is read. Null and empty texts have no features and the
    severity of the thresholds alone. Without labels of both kinds every severity is
    0. Null keys, repeated rows and other columns make no difference; an empty
    table gives an empty one.
    """
    labelled = labelled_sample(docs, labels, sample, key, text, longest)
    model = fit(labelled)
    reject_from = cut_off(labelled) if reject_from is None else reject_from
    scored = docs.select(F.col(key).alias("key"), severity(model, F.col(text)).alias("severity"))
    return scored.select(
        F.col("key").alias(key), "severity", (F.col("severity") >= reject_from).alias("rejected")
    )


def keep_clean(
    docs: DataFrame,
    labels: DataFrame,
    reject_from: float | None = None,
    sample: int = SAMPLE,
    longest: int = LONGEST,
) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``toxicity`` does not reject.

    Null and empty texts have no marks and stay; equal rows stay or go together. Without
    labels of both kinds all rows stay; an empty table gives an empty one.
    """
    labelled = labelled_sample(docs, labels, sample, longest=longest)
    model = fit(labelled)
    reject_from = cut_off(labelled) if reject_from is None else reject_from
    return docs.where(severity(model, F.col("text")) < reject_from)
