"""Importance resampling towards a target distribution, over hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.llm.shared import free_name, long_array, shared_folder, written
from surveil.operators.ordering import number_rows

# What each byte becomes: A-Z their lower case, every other ASCII byte but 0-9 and a-z a space. Bytes of other characters stay.
SPACED = bytes(
    c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c > 0x7F else c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 0x20
    for c in range(256)
)


def span_pattern(k: int) -> regex.Pattern:
    """``k`` words with single spaces between them, from the start of a word to the end of one."""
    return regex.compile(rb"(?<= )[^ ]++(?: [^ ]++){%d}(?![^ ])" % (k - 1))


def spans(text: bytes, patterns: list[regex.Pattern]) -> list[bytes]:
    """Every n-gram of the UTF-8 text where it starts, repeats included, for each length of ``patterns``."""
    spaced = b" " + b" ".join(text.translate(SPACED).split())
    return [m.group() for pattern in patterns for m in pattern.finditer(spaced, overlapped=True)]


def bucket_counts(rows: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """``rows`` with its last column, the text, replaced by n_words, n_features and hits.

    hits: the buckets of the text's n-grams, each with the number of n-grams in it.
    """
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(k) for k in range(1, max_n + 1)]
        for batch in batches:
            words, features, found, counts, offsets = [], [], [], [], [0]
            for value in batch.column(len(names)):
                found_spans = spans(value.as_buffer().to_pybytes() if value.is_valid else b"", patterns)
                ids = np.fromiter(map(crc32, found_spans), np.uint32, len(found_spans)) % np.uint32(buckets)
                own, n = np.unique(ids.astype(np.int32), return_counts=True)
                features.append(len(ids))
                words.append(n_words(len(ids), max_n))
                found.append(own)
                counts.append(n)
                offsets.append(offsets[-1] + len(own))
            none = [np.zeros(0, np.int32)]
            hits = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(found or none), pa.int32()), pa.array(np.concatenate(counts or none), pa.int64())], ["bucket", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hits)],
                names=[*names, "n_words", "n_features", "hits"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{fields + ', ' if fields else ''}n_words bigint, n_features bigint, hits array<struct<bucket: int, n: bigint>>"
    return rows.mapInArrow(run, schema)


def n_words(n_features: int, max_n: int) -> int:
    """Words of a text with so many n-grams: W words have W + (W-1) + ... of them, as far as they reach."""
    w = 0
    while w < max_n and w * (w + 1) // 2 < n_features:
        w += 1
    return w if w * (w + 1) // 2 == n_features and w < max_n else (n_features + max_n * (max_n - 1) // 2) // max_n


def totals(counted: DataFrame, buckets: int) -> list[int]:
    """N-grams per bucket over all rows: at most one number per bucket reaches the driver."""
    per = counted.select(F.inline("hits")).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for r in per.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Per bucket, a thousand times the log of its smoothed share in the target against that in the source, rounded down."""
    m, big_s, big_t = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log(float(t + 1) * float(big_s + m) / (float(s + 1) * float(big_t + m)))) for s, t in zip(source, target)]


def gumbel(seed: int, key: str) -> Column:
    """A thousand times a Gumbel draw that hashes seed and key, rounded down. A null key hashes as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh(
    rows: DataFrame, target: DataFrame, max_n: int, buckets: int, percent: int, min_words: int, seed: int
) -> DataFrame:
    """``rows`` (columns, key, text) without the text, with n_features, weight, score and rank."""
    own = rows.columns[:-1]
    counted = written(bucket_counts(rows, max_n, buckets), "buckets")
    gain = long_array(gains(totals(counted, buckets), totals(bucket_counts(target, max_n, buckets), buckets)))
    weight = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, h: total + F.get(gain, h["bucket"]) * h["n"])
    scored = counted.select(*own, "n_words", "n_features", weight.alias("weight"))
    scored = scored.withColumn("score", F.col("weight") + gumbel(seed, "key"))
    enough = F.col("n_words") >= min_words
    drawn = counted.filter(enough).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("key"), F.desc("weight"), F.desc("n_features")]
    ranked = number_rows(scored.filter(enough), order, f"{shared_folder(rows.sparkSession)}/ranked-{uuid4().hex}", name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).drop("n_words")


def importance(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    max_n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """One row per document: key, n_features, weight, score, and rank of those drawn.

    Texts are lower-cased (A-Z) and their separators collapsed to single spaces; an overlapped scan
    then emits every run of 1 to ``max_n`` words, whose CRC chooses one of ``buckets``. A document's
    weight sums the log share gained by its buckets in ``target`` against all of ``docs``; a Gumbel
    draw hashed from seed and key makes the highest scores a sample without replacement in
    proportion to exp(weight / 1000). Drawn are ``percent`` of the documents with at least
    ``min_words`` words, ties to smaller keys; others have no rank.

    Texts are scanned once, into a table of bucket counts. Null and empty texts have no features and
    weight 0; null keys hash as empty and come last in ties; rows that agree in key and text agree in
    all but rank. No documents give no rows; an empty target is a uniform one. Other columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = weigh(rows, target.select(F.col(target_text)), max_n, buckets, percent, min_words, seed)
    return out.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", **options
) -> DataFrame:
    """The drawn documents with all their columns, and ``rank`` (lengthened if the name is taken). Options as in ``importance``.

    Every document is written once, whole, beside its number in that table; only numbers are ranked.
    """
    rank = free_name(docs, "rank")
    numbered = written(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at")), "documents")
    rows = numbered.select("at", F.col(f"row.`{key}`").alias("key"), F.col(f"row.`{text}`").alias("text"))
    defaults = {"max_n": 1, "buckets": 10_000, "percent": 10, "min_words": 20, "seed": 2024}
    chosen = weigh(rows, target.select(F.col(target_text)), **{**defaults, **options}).filter("rank is not null")
    return numbered.join(chosen.select("at", "rank"), "at").select("row.*", F.col("rank").alias(rank))


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def oracle(buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024) -> str:
    """DuckDB SQL for ``importance`` with single words: CRC by its bitwise definition, over the distinct words."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH bits AS MATERIALIZED (
      SELECT list_transform(range(0, 256), lambda c:
        list_reduce(range(0, 8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, c::BIGINT)) AS t
    ), found AS MATERIALIZED (
      SELECT 0 AS kind, doc_id AS id, unnest(regexp_extract_all({lowered}, '{WORDS}')) AS w FROM documents
      UNION ALL
      SELECT 1, item_id, unnest(regexp_extract_all({lowered}, '{WORDS}')) FROM benchmark
    ), hexed AS MATERIALIZED (
      SELECT DISTINCT w, hex(encode(w)) AS h FROM found
    ), hashed AS MATERIALIZED (
      SELECT w, (xor(4294967295, list_reduce(
          list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT),
          lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295::BIGINT))) % {buckets} AS bucket
      FROM hexed, bits
    ), counted AS MATERIALIZED (
      SELECT kind, id, bucket, count(*) AS n FROM found JOIN hashed USING (w) GROUP BY ALL
    ), sums AS (
      SELECT sum(n) FILTER (kind = 0) AS s, sum(n) FILTER (kind = 1) AS t FROM counted
    ), gain AS MATERIALIZED (
      SELECT bucket, floor(1000 * ln(((b.t + 1)::DOUBLE * (sums.s + {buckets})::DOUBLE) / ((b.s + 1)::DOUBLE * (sums.t + {buckets})::DOUBLE)))::BIGINT AS gain
      FROM (SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM counted GROUP BY bucket) b, sums
    ), weighed AS (
      SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM counted JOIN gain USING (bucket) WHERE kind = 0 GROUP BY id
    ), scored AS MATERIALIZED (
      SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
      FROM documents LEFT JOIN weighed ON id IS NOT DISTINCT FROM doc_id
    ), ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * {percent} // 100 AS drawn FROM scored WHERE n_features >= {min_words}
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
    """
