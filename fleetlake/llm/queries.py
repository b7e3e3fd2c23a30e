"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.alignment import alignment
from fleetlake.llm.bpe_automaton import bpe_digests
from fleetlake.llm.collocations import collocations
from fleetlake.llm.embeddings import near_vectors
from fleetlake.llm.fingerprints import edit_likeness
from fleetlake.llm.language_id import language_id
from fleetlake.llm.packing import pack
from fleetlake.llm.secret_scans import BASE, MORE, secrets
from fleetlake.llm.sharding import shards
from fleetlake.llm.simhash import simhash_components
from fleetlake.llm.suffix_dedup import suffix_dedup
from fleetlake.llm.tables import ship
from fleetlake.llm.token_counts import token_counts
from fleetlake.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 400-byte strings that also start elsewhere, removed from every text.

    Passages of 50 words or more that also are elsewhere may be shorter; they are counted.
    """
    return suffix_dedup(documents(spark, sf_dir), window=400, gram=88, passages=240, words=50)


SHARD_BYTES = 1 << 20


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of at most a mebibyte of text."""
    return shards(documents(spark, sf_dir), SHARD_BYTES)


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all kinds in every text."""
    return secrets(documents(spark, sf_dir))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The severity of every text, by a model of the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(documents(spark, sf_dir), labels)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    return edit_likeness(documents(spark, sf_dir))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, by the word-end vocabulary; over_limit beyond 2048."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts(documents(spark, sf_dir), path, limit=2048)


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked within three bits."""
    return simhash_components(documents(spark, sf_dir), width=3, most=3)


@query
def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the automaton and decoded again, as digests."""
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label linked from a cosine of 0.93, and their components."""
    ship(spark)
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.93)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words of each language."""
    return collocations(documents(spark, sf_dir), most=2000, least=10, share=50)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned by bytes, with the counts of linked pairs."""
    paths = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment(documents(spark, sf_dir), *paths)


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, by a network of those that are not held out."""
    return language_id(documents(spark, sf_dir))


def _secrets_sql() -> str:
    """Each rule's matches and what is between them give places; all texts, whole."""
    finds = " UNION ALL ".join(
        f"""SELECT doc_id, t, {order} AS kind_order, '{r.kind}' AS kind, {r.least} AS least,
        regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {r.group}) AS vs,
        string_split_regex(t, '{p}') AS gaps FROM d"""
        for order, r in enumerate((*BASE, *MORE))
        for p in [r.pattern.replace("'", "''")]
    )
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({finds}),
    s AS (
        SELECT doc_id, kind_order, kind, least, length(vs[i]) AS n_value,
            list_sum([length(x) for x in gaps[1:i]])
                + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) AS start_at,
            length(ms[i]) AS n
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0)
    ),
    k AS (
        SELECT doc_id, kind_order, kind, start_at,
            concat(kind, ':', start_at::BIGINT, ':', (start_at + n)::BIGINT) AS span
        FROM s WHERE n_value >= least
    )
    SELECT d.doc_id,
        count(*) FILTER (WHERE kind = 'assign') AS n_assign,
        count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        sha256(coalesce(string_agg(span, ',' ORDER BY start_at, kind_order)
            FILTER (WHERE kind_order < {len(BASE)}), '')) AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY start_at, kind_order), '') AS spans
    FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    GROUP BY d.doc_id
    """


ORACLES["op3_secrets"] = _secrets_sql()

ORACLES["op2_sharding"] = f"""
WITH named AS (
    SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS name, md5(coalesce(text, '')) AS text_md5,
        strlen(coalesce(text, '')) AS n_bytes FROM documents
),
copies AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, text_md5, n_bytes) AS copy FROM named
),
d AS (
    SELECT doc_id, text_md5, copy, n_bytes,
        ('0x' || substr(md5(concat_ws(':', name, text_md5, copy)), 1, 15))::BIGINT AS hash
    FROM copies
),
p AS (
    SELECT d.*, depth, hash >> (60 - depth) AS prefix
    FROM d, (SELECT unnest(range(0, 61))::INTEGER AS depth)
),
nodes AS (
    SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
    FROM p GROUP BY depth, prefix HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1
)
SELECT doc_id, text_md5, copy, n_bytes, depth, prefix, shard_bytes, shard_rows
FROM p JOIN nodes USING (depth, prefix)
QUALIFY row_number() OVER (PARTITION BY doc_id, text_md5, copy ORDER BY depth) = 1
"""

ORACLES["op11_collocations"] = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
pieces AS (
    SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
phrases AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest([1, 2, 3]) AS size)
    WHERE i + size - 1 <= len(w)
    GROUP BY ALL
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang),
cuts AS (
    SELECT lang, phrase, size, f AS a, unnest(range(1, size)) AS k,
        string_split(phrase, ' ') AS w
    FROM phrases WHERE size > 1 AND f >= 10
),
scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
),
candidates AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a
    FROM (SELECT DISTINCT lang, w, a FROM cuts WHERE size = 3)
),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY lang, phrase),
ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM candidates c LEFT JOIN longest USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
