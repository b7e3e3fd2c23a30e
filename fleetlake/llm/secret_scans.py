"""Secrets in texts, by a trigram inverted index and DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.trigrams import Query, trigram_query, trigrams


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of a pattern whose group has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    found_by: str | None = None  # a pattern with the same matches that passes over short ones


# The patterns and lengths of the base kinds.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*"""
        r"""["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32,}"),
)
# Further kinds; what they find is added to the base kinds' spans.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

_SPANS = "array<struct<start:int,kind_order:int,end:int,kind:string>>"


def postings(docs: DataFrame, words: list[str], key: str, text: str) -> DataFrame:
    """The inverted index of the given trigrams: (trigram's number, key), once for each text."""
    lower = docs.select(F.col(key).alias("key"), F.lower(text).alias("lower"))
    held = [F.when(F.contains("lower", F.lit(w)), F.lit(i)) for i, w in enumerate(words)]
    return lower.select("key", F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def _holds(query: Query, number: dict[str, int], held: Column) -> Column:
    """Whether the trigrams held (as bits) meet a query."""
    if isinstance(query, str):
        return held.bitwiseAND(F.lit(1 << number[query])) != 0
    parts = [_holds(q, number, held) for q in query[1]]
    return reduce(Column.__and__ if query[0] == "and" else Column.__or__, parts)


def candidates(docs: DataFrame, rules: tuple[Rule, ...], key: str, text: str) -> DataFrame:
    """(key, may): for each key with any, the rules (as bits) whose postings intersect there.

    Rules without mandatory trigrams are not in it: they scan every text.
    """
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q is not True}
    words = sorted(set().union(*map(trigrams, indexed.values())))
    if len(words) > 62:
        raise ValueError("more mandatory trigrams than bits")
    number = {w: i for i, w in enumerate(words)}
    lists = postings(docs, words, key, text)
    held = lists.groupBy("key").agg(F.bit_or(F.expr("shiftleft(1L, trigram)")).alias("held"))
    bits = [
        F.when(_holds(q, number, F.col("held")), F.lit(1 << i)).otherwise(F.lit(0))
        for i, q in indexed.items()
    ]
    return held.select("key", reduce(Column.__add__, bits).alias("may")).where("may <> 0")


def _all(pattern: str, group: int) -> Column:
    return F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))


def _spans(rule: Rule, order: int, text: str, matches: str, values: str) -> Column:
    """Spans of the leftmost non-overlapping matches, from the lengths of what is between them."""
    between = F.split(text, rule.found_by or rule.pattern, -1)
    sizes = [
        F.transform(c, F.char_length).alias(name)
        for c, name in ((between, "gap"), (F.col(matches), "n"), (values, "of"))
    ]
    lengths = F.arrays_zip(*sizes)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(acc: Column, one: Column) -> Column:
        begin = acc["at"] + one["gap"]
        end = begin + one["n"]
        span = F.struct(
            begin.alias("start"),
            F.lit(order).alias("kind_order"),
            end.alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        keep = one["of"] >= rule.least
        longer = F.concat(acc["found"], F.array(span))
        found = F.when(keep, longer).otherwise(acc["found"])
        return F.struct(F.coalesce(end, begin).alias("at"), found.alias("found"))

    return F.aggregate(lengths, start, step, lambda acc: acc["found"])


def secret_spans(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, its text (null: empty), and its spans.

    ``spans`` is an array of (start, kind_order, end, kind) by start, then by
    the rules' order; places are code points, the end is exclusive. Per kind,
    matches are the leftmost non-overlapping ones; those whose group is too short
    are dropped. The index only says which texts a rule is run on: it is by key,
    so rows that share a key share candidates, and null is a key like any other.
    Empty tables give empty ones.
    """
    may = candidates(docs, rules, key, text).select(F.col("key").alias("_key"), "may")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("_own"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    # the candidates are built into each task's hash table: only texts are moved, none are sorted
    same = F.col("_own").eqNullSafe(F.col("_key"))
    joined = rows.join(may.hint("shuffle_hash"), same, "left").select(
        "row", "_text", F.coalesce("may", F.lit(0)).alias("_may")
    )
    none = F.array().cast("array<string>")
    indexed = [trigram_query(r.pattern) is not True for r in rules]
    run = [
        F.col("_may").bitwiseAND(F.lit(1 << i)) != 0 if indexed[i] else F.lit(True)
        for i in range(len(rules))
    ]
    found = joined.select(
        "*",
        *(
            F.when(run[i], _all(r.found_by or r.pattern, 0)).otherwise(none).alias(f"_m{i}")
            for i, r in enumerate(rules)
        ),
    )
    empty = F.array().cast(_SPANS)
    spans = []
    for i, r in enumerate(rules):
        values = _all(r.pattern, r.group) if r.group else F.col(f"_m{i}")
        some = _spans(r, i, "_text", f"_m{i}", values)
        spans.append(F.when(F.size(f"_m{i}") > 0, some).otherwise(empty))
    every = F.array_sort(F.concat(*spans))
    return found.select("row", F.col("_text").alias("text"), every.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) of every row; see ``secret_spans``."""
    found = secret_spans(docs.select(key, text), rules, key, text)
    base = F.filter("spans", lambda s: s["kind_order"] < len(BASE))
    counts = [_count(r.kind).alias(f"n_{r.kind}") for r in BASE]
    return found.select(
        F.col(f"row.{key}").alias(key),
        *counts,
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redact(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with every span of a secret replaced by its kind in brackets.

    Overlapping spans are replaced by the first one's kind. Null texts stay
    null, and texts without secrets stay as they are.
    """
    found = secret_spans(docs, rules, key, text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        marked = F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]"))
        after = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(after, marked).otherwise(acc["out"]).alias("out"),
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))
        return F.concat(acc["out"], rest)

    clean = F.aggregate("spans", start, step, finish)
    changed = F.when(F.size("spans") > 0, clean).otherwise(F.col(f"row.{text}")).alias(text)
    return found.select(*(changed if c == text else F.col(f"row.{c}") for c in docs.columns))
