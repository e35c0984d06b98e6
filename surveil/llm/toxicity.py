"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from surveil.llm.shared import written

WORD = regex.compile(r"[^\W\d_]++")
PREFIXES = range(3, 9)  # lengths
CACHE_WORDS = 400_000


def word_features(word: str) -> list[str]:
    """The word, and each of its proper prefixes, marked as one."""
    return [word, *(f"{word[:k]}-" for k in PREFIXES if k < len(word))]


def text_features(text: str) -> set[str]:
    """What occurs in the whole text; how often does not count."""
    return {f for w in set(WORD.findall(text.lower())) for f in word_features(w)}


@dataclass
class PuClassifier:
    """A linear classifier over features that occur in a text or not."""

    features: list[str]
    weights: np.ndarray
    bias: float = 0.0
    index: dict[str, int] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.index = {f: i for i, f in enumerate(self.features)}

    def scorer(self):
        """Text to probability. A word is looked up once as long as it is remembered."""
        known: dict[str, tuple[int, ...]] = {}

        def of(word: str) -> tuple[int, ...]:
            ids = known.get(word)
            if ids is None:
                ids = tuple(self.index[f] for f in word_features(word) if f in self.index)
                if len(known) < CACHE_WORDS:
                    known[word] = ids
            return ids

        def score(text: str) -> float:
            present = sorted({i for w in set(WORD.findall(text.lower())) for i in of(w)})
            return float(0.5 * np.tanh(0.5 * (self.weights[present].sum() + self.bias)) + 0.5)

        return score


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * z) + 0.5


def pu_risk(z_pos: np.ndarray, z_unl: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the logistic risk that positive and unlabelled logits give: of positives, and of negatives.

    Unlabelled text holds a share ``prior`` of positives; what they add to the negatives' risk is taken
    off again. An estimate that is below zero has learned the examples by heart.
    """
    return prior * softplus(-z_pos).mean(), softplus(z_unl).mean() - prior * softplus(z_pos).mean()


def risk_slopes(z_pos: np.ndarray, z_unl: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What a training step follows, by logit: the risk, or, where the negatives' part is below zero, the way back up."""
    up_pos, up_unl = sigmoid(z_pos) / len(z_pos), sigmoid(z_unl) / len(z_unl)
    if pu_risk(z_pos, z_unl, prior)[1] >= 0:
        return prior * (up_pos - 1.0 / len(z_pos)) - prior * up_pos, up_unl
    return prior * up_pos, -up_unl


def train(
    pos: np.ndarray, unl: np.ndarray, prior: float, steps: int, batch: int, rate: float, decay: float, keep: float, rng: np.random.Generator
) -> tuple[np.ndarray, float, list[float]]:
    """Weights, bias and the risks on the way, by Adam over batches of both kinds.

    A batch sees each feature of a text with chance ``keep`` only, so that a text with a single telling
    word is learned from texts with many.
    """
    def drawn(rows: np.ndarray, n: int) -> np.ndarray:
        x = rows[rng.integers(0, len(rows), n)]
        return x * (rng.integers(0, 256, x.shape, np.uint8) < 256 * keep)

    w, b = np.zeros(pos.shape[1]), np.array([np.log(prior / (1 - prior))])
    params, first, second = [w, b], [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    risks = []
    for step in range(1, steps + 1):
        x_pos, x_unl = drawn(pos, batch), drawn(unl, 3 * batch)
        z_pos, z_unl = x_pos @ w + b, x_unl @ w + b
        risks.append(sum(pu_risk(z_pos, z_unl, prior)))
        s_pos, s_unl = risk_slopes(z_pos, z_unl, prior)
        grads = [s_pos @ x_pos + s_unl @ x_unl + decay * w, np.array([s_pos.sum() + s_unl.sum()])]
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for x, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, float(b[0]), risks


def held_out(key: str, buckets: int = 5, held: int = 0) -> Column:
    """crc32 of the key as text, mod ``buckets``, is ``held``. A null key is held out: nothing is learned from it."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % buckets == held, F.lit(True))


def _matrix(rows: Sequence[Sequence[int]], scales: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(scales)), np.float32)
    for i, present in enumerate(rows):
        out[i, present] = scales[present]
    return out


def _sampled(rows: DataFrame, n: int, limit: int) -> DataFrame:
    """At most ``limit`` of ``n`` rows, those with the least ``h``; tasks send hardly more than twice as many in all."""
    if n > 4 * limit:
        rows = rows.filter(F.col("h") < -(2**63) + 2**64 * 2 * limit // n)
    return rows.orderBy("h", *[c for c in rows.columns if c != "h"]).limit(limit)


def draw_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_positive: int, max_unlabelled: int
) -> tuple[DataFrame | None, float]:
    """(positive, text) of the training sample, and the share of positives among the labelled training rows."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter(~held_out("key"))
    known = known.groupBy("key").agg(F.max("label").alias("label")).filter("label is not null")  # of several labels one that confirms is enough
    known = written(known, "labels")
    n_known, n_pos = known.agg(F.count("*"), F.count(F.when(F.col("label") > 0, 1))).first()
    if not n_pos:
        return None, 0.0
    confirmed = known.filter("label > 0").select("key", F.xxhash64("key", F.lit(1)).alias("h"))
    confirmed = _sampled(confirmed, n_pos, max_positive).select(F.col("key").alias("confirmed"))  # this many keys at most: safe to broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(~held_out("key") & F.col("text").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("key", F.substring(F.md5("text"), 1, 8), F.lit(2)))
    n_docs = docs.select(key).count()
    bound = -(2**63) + min(2**64 - 1, 2**64 * 2 * max_unlabelled // max(1, n_docs))
    rows = rows.join(F.broadcast(confirmed), F.col("key") == F.col("confirmed"), "left")
    rows = written(rows.filter((F.col("h") < bound) | F.col("confirmed").isNotNull()).drop("key"), "drawn")
    kinds = {True: rows.filter("confirmed is not null"), False: rows.filter(F.col("h") < bound)}
    parts = [_sampled(rows.select("h", "text"), 0, limit).select(F.lit(positive).alias("positive"), "text") for (positive, rows), limit in zip(kinds.items(), (max_positive, max_unlabelled))]
    return written(parts[0].unionByName(parts[1]).distinct(), "sample"), n_pos / n_known


def _mapped(rows: DataFrame, kind: str, of) -> DataFrame:
    """(positive, found) per (positive, text), ``of`` applied to the text's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of(text_features(v.as_py())) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kinds[kind]))], names=["positive", "found"])

    kinds = {"string": pa.string(), "int": pa.int32()}
    return rows.mapInArrow(run, f"positive boolean, found array<{kind}>")


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_positive: int = 1000, max_unlabelled: int = 4000, max_features: int = 4096, min_texts: int = 8, full_weight: float = 12.0,
    steps: int = 800, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, keep: float = 0.5, seed: int = 13,
) -> PuClassifier | None:
    """The classifier learned from rows that ``held_out`` does not hold out; None without a confirmed example.

    Learned from: texts that ``labels`` confirms (label 1), and texts of any kind, whose labels are
    not looked at. Both are bounded samples, those with the least hash: ``max_positive``
    and ``max_unlabelled`` whole texts, equal ones once. The class prior is the share of label 1 among all
    labelled training rows. Features are words and word prefixes that at least ``min_texts`` sampled texts hold:
    the ``max_features`` whose shares in the two samples differ most, measured in standard errors. One that
    differs by fewer than ``full_weight`` of them counts for less, in proportion.
    """
    sample, prior = draw_sample(docs, labels, key, text, label, max_positive, max_unlabelled)
    if sample is None:
        return None
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    n_pos, n_unl = float(sizes[True]), float(sizes[False])
    sample = sample.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = _mapped(sample, "string", sorted).select("positive", F.explode("found").alias("feature"))
    per = found.groupBy("feature").agg(F.count(F.when(F.col("positive"), 1)).alias("pos"), F.count(F.when(~F.col("positive"), 1)).alias("unl"))
    share = (F.col("pos") + F.col("unl")) / F.lit(n_pos + n_unl)
    gap = F.col("pos") / F.lit(n_pos) - F.col("unl") / F.lit(n_unl)
    errors = F.abs(gap) / F.sqrt(share * (F.lit(1.0 + 1e-9) - share) * F.lit(1 / n_pos + 1 / n_unl))
    best = per.filter(F.col("pos") + F.col("unl") >= min_texts).select("feature", errors.alias("errors"))
    best = best.orderBy(F.desc("errors"), "feature").limit(max_features).collect()
    if not best:
        return None
    features = [r["feature"] for r in best]
    index = {f: i for i, f in enumerate(features)}
    scales = np.minimum(np.array([r["errors"] for r in best]) / full_weight, 1.0)
    rows = _mapped(sample, "int", lambda fs: sorted(index[f] for f in fs if f in index)).collect()
    pos, unl = ([r["found"] for r in sorted(rows, key=lambda r: r["found"]) if r["positive"] == kind] for kind in (True, False))
    rng = np.random.default_rng(seed)
    w, b, _ = train(_matrix(pos, scales), _matrix(unl, scales), min(prior, 0.99), steps, batch, rate, decay, keep, rng)
    return PuClassifier(features, w * scales, b)


def predict(docs: DataFrame, model: PuClassifier | None, text: str = "text") -> DataFrame:
    """The columns of ``docs``, score (0 to 1, higher: likelier toxic) and predicted (1 from 0.5 on).

    Only the whole ``text`` is looked at: null and empty ones have the score of a text without any feature, equal
    ones equal scores. Without a model every score is 0. Columns of ``docs`` called score or
    predicted are replaced; no rows give no rows.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("score", "predicted")])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer() if model else lambda text: 0.0
        for batch in batches:
            scores = np.array([score(v.as_py() or "") for v in batch.column(at)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"]
            )

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)
