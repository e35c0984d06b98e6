"""SimHash fingerprints of 128 bits, and search within a Hamming radius. Native."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.llm.shared import long_array
from surveil.operators.joins import skew_join

WORDS = "[\\x20\\x09-\\x0D]+"
BITS = 128
SHINGLE = 3
NEAR = 23  # bits: of the pairs at sf0.1 with a five-word Jaccard of 0.75 or more, 129 of 135 are so near
CELL_ROWS, MAX_CELLS = 500, 2048
LANES = 0x0000000100000001  # bits i and i + 32 of a hash, as two counters of 32 bits


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORDS), "")


def terms(words: Column, shingle: int = SHINGLE) -> Column:
    """The word shingles as structs; with fewer words, one term of them all, and none without words."""
    n = F.size(words)
    shifted = [F.slice(words, i + 1, F.greatest(n - i, F.lit(0))) for i in range(shingle)]
    return F.slice(F.arrays_zip(*[s.alias(f"w{i}") for i, s in enumerate(shifted)]), 1, F.greatest(n - shingle + 1, F.least(n, F.lit(1))))


def fingerprints(df: DataFrame, keys: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per ``keys``: keys, high and low (the fingerprint's halves) and fingerprint (32 hex digits).

    Each occurrence of a term votes with its hash, so a term weighs as often as it occurs. 32 sums
    count the votes of 64 bits, a half: bits i and i + 32 of a hash share a sum as counters of 32 bits. A
    bit is set if more than half of the votes are ones. Texts with equal words have equal
    fingerprints; null texts and texts without words have no votes and fingerprint 0. Rows with equal
    keys vote together, so keys must tell rows apart. Only ``keys`` and ``text`` are read.
    """
    split = df.select(*keys, words(F.col(text)).alias("__w"))
    exploded = split.select(*keys, F.explode_outer(terms(F.col("__w"), shingle)).alias("__t"))
    parts = [F.col(f"__t.w{i}") for i in range(shingle)]
    # a row per term and half: one half's 32 sums are as much as one compiled loop should hold
    halves = exploded.withColumn("__half", F.explode(F.array(F.lit(0), F.lit(1))))
    hashed = halves.select(
        *keys, "__half",
        F.col("__t").isNotNull().cast("long").alias("__one"),
        F.when(F.col("__t").isNotNull(), F.xxhash64("__half", *parts)).otherwise(F.lit(0)).alias("__h"),
    )
    sums = [F.sum(F.shiftrightunsigned("__h", i).bitwiseAND(F.lit(LANES))).alias(f"__s{i}") for i in range(32)]
    votes = hashed.groupBy(*keys, "__half").agg(F.sum("__one").alias("__n"), *sums)
    bits = votes.select(*keys, "__half", _bits().alias("__bits"))
    wide = bits.groupBy(*keys).agg(*[F.max(F.when(F.col("__half") == h, F.col("__bits"))).alias(n) for h, n in ((0, "high"), (1, "low"))])
    return wide.withColumn("fingerprint", F.concat(_hex("high"), _hex("low")))


def _bits() -> Column:
    sums = F.array(*[F.col(f"__s{i}") for i in range(32)])
    low = F.lit(0xFFFFFFFF)

    def bits(s: Column, i: Column) -> Column:
        one = F.lit(1).cast("long")
        return F.when(s.bitwiseAND(low) * 2 > F.col("__n"), F.call_function("shiftleft", one, i)).otherwise(F.lit(0)).bitwiseOR(
            F.when(F.shiftrightunsigned(s, 32) * 2 > F.col("__n"), F.call_function("shiftleft", one, i + 32)).otherwise(F.lit(0))
        )

    return F.aggregate(F.transform(sums, bits), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _hex(half: str) -> Column:
    return F.lower(F.lpad(F.hex(half), 16, "0"))


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Hamming distance of two fingerprints, given as pairs of column names."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)])


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits: about 0.5 for unrelated texts, 1 for equal fingerprints."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def _blocks(radius: int, flips: int) -> tuple[int, int]:
    """(bits of a block, bits by which some block differs at most): the fewest blocks, none over 32 bits, in which that is ``flips`` or less."""
    bits = next(b for b in (32, 16, 8, 4, 2, 1) if radius // (BITS // b) <= flips or b == 1)
    return bits, radius // (BITS // bits)


def _block(high: str, low: str, i: int, bits: int) -> Column:
    per_half = 64 // bits
    half = F.col(high if i < per_half else low)
    return F.shiftrightunsigned(half, i % per_half * bits).bitwiseAND(F.lit((1 << bits) - 1))


def slots(df: DataFrame, radius: int, flips: int, asked: bool) -> DataFrame:
    """Each row once per block of its bits, with the block's number and value as ``slot``; if ``asked``, once per value that it may have.

    Fingerprints within the radius differ by no more than radius / blocks, rounded down, in at least one
    block. The asked ones are given every value so near to theirs, the others their own alone.
    """
    bits, most = _blocks(radius, flips)
    masks = [sum(1 << b for b in chosen) for n in range(most + 1 if asked else 1) for chosen in combinations(range(bits), n)]
    own = [F.shiftleft(F.lit(i).cast("long"), bits).bitwiseOR(_block("high", "low", i, bits)) for i in range(BITS // bits)]
    rows = df.select(*df.columns, F.explode(F.array(*own)).alias("__own"))
    return rows.select(*df.columns, F.explode(long_array(masks)).alias("__mask"), "__own").select(
        *df.columns, F.col("__own").bitwiseXOR(F.col("__mask")).alias("slot")
    )


def search(all_rows: DataFrame, queries: DataFrame, radius: int = 3, flips: int = 2) -> DataFrame:
    """Per distinct query fingerprint (high, low): n_within, the rows of ``all_rows`` within ``radius``, itself included if there.

    Equal fingerprints are counted first and compared once, so copies cost nothing. Exact: the
    slots find every fingerprint within the radius, the distance decides, and a pair that meets in several
    counts in the first. ``flips`` bounds the bits by which a query's blocks are varied; a larger radius
    so takes more and shorter blocks, which more fingerprints share by chance.
    """
    bits, most = _blocks(radius, flips)
    held = all_rows.groupBy("high", "low").agg(F.count("*").alias("n"))
    asked = queries.select("high", "low").distinct()
    asked_slots = slots(asked, radius, flips, asked=True).withColumnsRenamed({"high": "q_high", "low": "q_low"})
    # Spark cannot tell how many rows the explodes make and would broadcast them by a far too small estimate
    near = skew_join(slots(held, radius, flips, asked=False), asked_slots.hint("merge"), ["slot"])
    near = near.filter(distance(("high", "low"), ("q_high", "q_low")) <= radius)
    first = F.coalesce(*[
        F.when(F.bit_count(_block("high", "low", i, bits).bitwiseXOR(_block("q_high", "q_low", i, bits))) <= most, F.lit(i)) for i in range(BITS // bits)
    ])
    near = near.filter(F.shiftright("slot", bits) == first)
    return near.groupBy("q_high", "q_low").agg(F.sum("n").alias("n_within")).withColumnsRenamed({"q_high": "high", "q_low": "low"})


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row with the text of the next in descending key order, after the last the first: cell, rn, guest, key, text, next_text.

    Keys are cut at approximate quantiles into cells; each cell gets as a guest (last in it,
    marked) the first row of the following cell, so one shuffle by cell is all. Rows with equal
    keys are ordered by a hash of their text; null keys come last. One row follows itself.
    Callers drop the guests.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = rows.count()
    cells = max(1, min(MAX_CELLS, n // CELL_ROWS))
    cuts = rows.agg(F.percentile_approx("key", [i / cells for i in range(1, cells)] or [0.5], 20 * MAX_CELLS)).first()[0] or []
    cuts = sorted(set(cuts)) if cells > 1 else []
    cell = F.size(F.filter(long_array(cuts), lambda c: c > F.col("key"))) if cuts else F.lit(0)
    rows = rows.withColumns({
        "hash": F.xxhash64("text"),
        "cell": F.when(F.col("key").isNull(), F.lit(len(cuts))).otherwise(cell).cast("int"),
    })
    # at most MAX_CELLS + 1 rows
    firsts = sorted(rows.groupBy("cell").agg(F.max(F.struct("key", "hash")).alias("f")).collect())
    guests = [(firsts[i]["f"]["key"], firsts[i]["f"]["hash"], firsts[i - 1]["cell"]) for i in range(len(firsts))]
    guests = spark.createDataFrame(guests, f"k {docs.schema[key].dataType.simpleString()}, h long, at int")
    rows = rows.join(F.broadcast(guests), F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h")), "left")
    places = F.array_compact(F.array(F.struct("cell", F.lit(0).alias("guest")), F.when(F.col("at").isNotNull(), F.struct(F.col("at").alias("cell"), F.lit(1).alias("guest")))))
    rows = rows.select("key", "hash", "text", F.explode(places).alias("p")).select("key", "hash", "text", "p.*")
    order = Window.partitionBy("cell").orderBy("guest", F.col("key").desc_nulls_last(), F.col("hash").desc())
    rows = rows.withColumns({"rn": F.row_number().over(order), "next_text": F.lead("text").over(order)})
    return rows.select("cell", "rn", "guest", F.col("key").alias(key), "text", "next_text")


def next_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and their likenesses.

    The edited text has its last half replaced by the beginning of the next document
    (``with_next``). One row per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    high, low, near_edited, near_next. A null text counts as empty. Whatever follows the one
    shuffle by cell stays in its partition.
    """
    rows = with_next(docs, key, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), half))
    both = rows.select(
        "cell", "rn", "guest", F.col(key).alias("key"), n.cast("long").alias("n_chars"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("which"), F.col("text")),
            F.struct(F.lit(1).alias("which"), F.when(F.col("guest") == 0, edited).alias("text")),
        )),
    ).withColumn("sha", F.when(F.col("which") == 1, F.sha2("text", 256)))
    keys = ["cell", "rn", "guest", "key", "n_chars", "which", "sha"]
    prints = fingerprints(both, keys)
    pick = lambda c, w: F.max(F.when(F.col("which") == w, F.col(c)))
    wide = prints.groupBy("cell", "rn", "guest", "key", "n_chars").agg(
        pick("sha", 1).alias("edited_sha256"), pick("fingerprint", 0).alias("fingerprint"), pick("fingerprint", 1).alias("edited_fingerprint"),
        *[pick(h, w).alias(f"{h}{w}") for h in ("high", "low") for w in (0, 1)],
    )
    order = Window.partitionBy("cell").orderBy("rn")
    wide = wide.withColumns({f"next_{h}": F.lead(f"{h}0").over(order) for h in ("high", "low")}).filter("guest = 0")
    return wide.select(
        F.col("key").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.col("high0").alias("high"), F.col("low0").alias("low"),
        likeness(("high0", "low0"), ("high1", "low1")).alias("near_edited"),
        likeness(("high0", "low0"), ("next_high", "next_low")).alias("near_next"),
    )
