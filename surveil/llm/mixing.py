"""Mixing sources to target weights by Poisson replication. Native."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.operators.joins import skew_join

UNIFORM_BITS = 52
KEY_BITS = 60
OWN = ("rate", "copy", "shuffle_key")  # the columns that are added
MAX_RATE = 500.0  # exp(-rate) must stay a normal number


def uniform(seed: int, *key: str) -> Column:
    """A number in (0, 1) from a hash of seed and key: the same wherever and whenever it is taken."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]]
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, UNIFORM_BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**UNIFORM_BITS))


def poisson(u: Column, rate: Column) -> Column:
    """The Poisson distribution inverted at ``u``: the least k with u <= P(X <= k).

    The steps of the inversion are bounded by the tail in which no 52-bit number lies.
    """
    steps = F.sequence(F.lit(1), F.ceil(rate + 9 * F.sqrt(rate) + 40).cast("int"))
    start = F.struct(
        F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("cdf")
    )

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        return F.when(u <= s["cdf"], s).otherwise(F.struct(i.alias("k"), p.alias("p"), (s["cdf"] + p).alias("cdf")))

    return F.aggregate(steps, start, step, lambda s: s["k"])


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    default_weight: float = 1.0,
    source: str = "source",
    text: str = "text",
    budget: float = 1.0,
) -> DataFrame:
    """Mean repetition per source: its share of ``budget`` times all bytes, over its own bytes plus one per row.

    ``weights`` are relative, sources not listed have ``default_weight``. A null source is a
    source. A source of weight 0 has rate 0.
    """
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("bytes"))
    weight = F.lit(float(default_weight))
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source") == F.lit(name), F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.struct(F.sum("weight").alias("weight"), F.sum("bytes").alias("bytes")).alias("t"))
    share = F.col("weight") / F.col("t.weight") * F.col("t.bytes") * F.lit(float(budget))
    return sizes.withColumn("t", total.scalar()).select("source", "bytes", "weight", (share / F.col("bytes")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    default_weight: float = 1.0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    budget: float = 1.0,
    seed: int = 17,
    names: tuple[str, str, str] = OWN,
) -> DataFrame:
    """Every row as often as its draw says, all shuffled: the columns of ``docs``, then rate, copy and shuffle_key.

    A row's number of copies is Poisson with the rate of its source, inverted at a number that
    hashes seed, key and text, so it does not depend on partitions or retries. A source's
    expected bytes are its target. Copies are numbered from 0 and ordered by a hash of the copy,
    so that they lie apart; the order is a range partitioning of that hash with rows sorted inside.

    Equal rows draw alike. Null keys and texts hash as empty; a null source has its own rate.
    Empty texts weigh one byte. No rows in, no rows out. Rates above ``MAX_RATE`` are drawn as a sum
    of equal parts. ``names`` are those of the added columns; columns of ``docs`` called so are refused.
    """
    rate, copy, shuffle_key = names
    clash = {n.lower() for n in names} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"rename the input columns {sorted(clash)}")
    rates = source_rates(docs, weights, default_weight, source, text, budget).select(F.col("source").alias(source), F.col("rate").alias(rate))
    rows = skew_join(docs, rates, [source])
    rows = rows.withColumn("__id", F.md5(F.coalesce(F.col(text), F.lit(""))))
    # a sum of equal Poisson parts; nearly always one
    parts = F.greatest(F.ceil(F.col(rate) / MAX_RATE), F.lit(1)).cast("int")
    rows = rows.withColumn("__u", F.struct(uniform(seed, key, "__id").alias("u"), parts.alias("parts")))
    first = poisson(F.col("__u.u"), F.col(rate) / F.col("__u.parts"))
    more = F.aggregate(
        F.filter(F.sequence(F.lit(1), F.col("__u.parts")), lambda i: i > 1),
        F.lit(0),
        lambda n, i: n + poisson(_again(seed, key, i), F.col(rate) / F.col("__u.parts")),
    )
    rows = rows.withColumn("__n", first + more)
    rows = rows.filter("__n > 0").withColumn(copy, F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    order = F.md5(F.concat_ws("/", F.lit(f"{seed}o"), F.coalesce(F.col(key).cast("string"), F.lit("")), "__id", F.col(copy).cast("string")))
    rows = rows.withColumn(shuffle_key, F.conv(F.substring(order, 1, 15), 16, 10).cast("long"))
    rows = rows.select(*docs.columns, *names)
    # the keys are uniform, so equal ranges of them need no sampling pass over the texts
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.shiftright(F.shiftright(shuffle_key, KEY_BITS - 30) * n, 30).cast("int")
    return rows.repartitionById(n, part).sortWithinPartitions(shuffle_key)


def _again(seed: int, key: str, i: Column) -> Column:
    parts = [F.lit(f"{seed}+"), i.cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("__id")]
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, UNIFORM_BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**UNIFORM_BITS))


def oracle(seed: int = 17) -> str:
    """DuckDB SQL for ``mix_sources`` with equal weights: the distribution is tabulated per source."""
    return f"""
    WITH d AS (
      SELECT *, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS h FROM documents
    ), s AS (
      SELECT source, sum(size) AS bytes FROM d GROUP BY source
    ), r AS (
      SELECT source, 1.0::DOUBLE / (SELECT sum(1.0::DOUBLE) FROM s) * (SELECT sum(bytes) FROM s)::DOUBLE * 1.0::DOUBLE / bytes::DOUBLE AS rate FROM s
    ), c AS (
      SELECT source, rate, k,
        sum(CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END)
          OVER (PARTITION BY source ORDER BY k) AS cdf
      FROM r, range(0, 200) t(k)
    ), u AS (
      SELECT d.*, (('0x' || substr(md5('{seed}/' || coalesce(doc_id::VARCHAR, '') || '/' || h), 1, 13))::BIGINT::DOUBLE + 0.5)
        / 4503599627370496.0 AS u FROM d
    ), n AS (
      SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, u.h, r.rate,
        (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf < u.u) AS n
      FROM u JOIN r ON r.source IS NOT DISTINCT FROM u.source
    ), e AS (
      SELECT *, unnest(range(0, n)) AS k FROM n
    )
    SELECT doc_id, text, lang, source, n_chars, rate, k::INTEGER AS copy,
      ('0x' || substr(md5('{seed}o/' || coalesce(doc_id::VARCHAR, '') || '/' || h || '/' || k::VARCHAR), 1, 15))::BIGINT AS shuffle_key
    FROM e
    """
