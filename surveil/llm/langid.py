"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from surveil.llm.shared import frugal

UNIT_BYTES = 32  # the network runs over words; longer ones are cut
CACHE_WORDS = 250_000
CHUNK_WORDS = 100_000  # words of documents that are looked up together
EVAL_UNITS = 1024  # their states are held at all positions
BATCH_ROWS = 1000  # that a task hands on at once
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class BiGru:
    """Two gated recurrent layers over bytes, one per direction, and a label distribution at every position.

    Per direction: ``w`` (256, 3H) the input to the update, reset and candidate gates, ``u`` (H, 3H)
    the state to them. ``v`` (2H, C) and ``c`` (C): the labels.
    """

    w: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    c: np.ndarray

    @classmethod
    def new(cls, hidden: int, classes: int, rng: np.random.Generator) -> BiGru:
        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.25).astype(np.float32)

        return cls(
            [draw(256, 3 * hidden) for _ in (0, 1)], [draw(hidden, 3 * hidden) for _ in (0, 1)],
            draw(2 * hidden, classes), np.zeros(classes, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.w, *self.u, self.v, self.c]

    def _direction(self, d: int, units: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States (T, N, H). ``units`` (N, T) bytes. Where ``mask`` is 0 the state stays as it was."""
        n, length = units.shape
        h_dim = self.u[d].shape[0]
        h = np.zeros((n, h_dim), np.float32)
        states = np.empty((length, n, h_dim), np.float32)
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            x = self.w[d][units[:, t]]
            s = h @ self.u[d]
            zr = _sigmoid(x[:, : 2 * h_dim] + s[:, : 2 * h_dim])
            z, r = zr[:, :h_dim], zr[:, h_dim:]
            cand = np.tanh(x[:, 2 * h_dim :] + r * s[:, 2 * h_dim :])
            m = mask[:, t : t + 1]
            new = h + m * ((1 - z) * (cand - h))
            if keep is not None:
                keep.append((t, h, z, r, cand, s[:, 2 * h_dim :], m))
            states[t] = h = new
        return states

    def log_probs(self, units: np.ndarray, mask: np.ndarray, kept: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log label probabilities (T, N, C) and the states (T, N, 2H)."""
        keeps = [None, None] if kept is None else kept
        both = np.concatenate([self._direction(d, units, mask, keeps[d]) for d in (0, 1)], axis=2)
        logits = both @ self.v + self.c
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True)), both

    def gradients(self, units: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        kept: list[list] = [[], []]
        logp, both = self.log_probs(units, mask, kept)
        total = mask.sum()
        weight = mask.T[:, :, None] / total
        loss = -float((np.take_along_axis(logp, labels[None, :, None], 2) * weight).sum())
        d_logits = np.exp(logp)
        d_logits[:, np.arange(len(labels)), labels] -= 1
        d_logits *= weight
        d_v = np.einsum("tnh,tnc->hc", both, d_logits)
        d_both = d_logits @ self.v.T
        h_dim = self.u[0].shape[0]
        one_hot = np.eye(256, dtype=np.float32)
        d_w, d_u = [np.zeros_like(x) for x in self.w], [np.zeros_like(x) for x in self.u]
        for d in (0, 1):
            d_h = np.zeros((units.shape[0], h_dim), np.float32)
            for t, h, z, r, cand, s_n, m in reversed(kept[d]):
                d_h = d_h + d_both[t][:, d * h_dim : (d + 1) * h_dim]
                d_cand = d_h * m * (1 - z) * (1 - cand * cand)
                d_z = d_h * m * (h - cand) * z * (1 - z)
                d_r = d_cand * s_n * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_cand], axis=1)
                d_s = np.concatenate([d_z, d_r, d_cand * r], axis=1)
                d_w[d] += one_hot[units[:, t]].T @ d_x
                d_u[d] += h.T @ d_s
                d_h = d_h * (1 - m * (1 - z)) + d_s @ self.u[d].T
        return loss, [*d_w, *d_u, d_v, d_logits.sum(axis=(0, 1))]

    def train(self, units: np.ndarray, mask: np.ndarray, labels: np.ndarray, steps: int, batch: int, rate: float, rng: np.random.Generator) -> list[float]:
        """Adam on random batches; the losses."""
        weights = self.weights()
        first, second = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
        losses = []
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(units), batch)
            width = max(1, int(mask[pick].sum(axis=1).max()))
            loss, grads = self.gradients(units[pick, :width], mask[pick, :width], labels[pick])
            losses.append(loss)
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for x, g, a, b in zip(weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                x -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return losses


def units_of(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as units of at most ``UNIT_BYTES`` bytes: bytes (N, T), mask (N, T) and the word of each unit."""
    parts, owner = [], []
    for i, word in enumerate(words):
        raw = word.encode("utf-8", "surrogatepass")
        for at in range(0, len(raw), UNIT_BYTES):
            parts.append(raw[at : at + UNIT_BYTES])
            owner.append(i)
    width = max(map(len, parts), default=1)
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return flat, (np.arange(width) < sizes[:, None]).astype(np.float32), np.array(owner, np.int64)


def word_scores(model: BiGru, words: list[str]) -> np.ndarray:
    """Per word: the log label probabilities summed over its positions, then the number of positions."""
    out = np.zeros((len(words), len(model.c) + 1))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))  # words of a batch are of about one length
    for at in range(0, len(order), EVAL_UNITS):
        chosen = order[at : at + EVAL_UNITS]
        units, mask, owner = units_of([words[i] for i in chosen])
        for lo in range(0, len(units), EVAL_UNITS):
            part, m, own = units[lo : lo + EVAL_UNITS], mask[lo : lo + EVAL_UNITS], owner[lo : lo + EVAL_UNITS]
            logp, _ = model.log_probs(part, m)
            sums = np.concatenate([(logp * m.T[:, :, None]).sum(axis=0), m.sum(axis=1)[:, None]], axis=1)
            np.add.at(out, np.array(chosen)[own], sums)
    return out


def held_out(key: str, buckets: int = 5, held: int = 0) -> Column:
    """crc32 of the key as text, mod ``buckets``, is ``held``. A null key is held out: nothing is learned from it."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % buckets == held, F.lit(True))


def training_words(
    docs: DataFrame, key: str, text: str, label: str, docs_per_label: int, words_per_doc: int, max_labels: int
) -> tuple[list[str], list[str], list[int]]:
    """Labels, words and the label number of each word, from a bounded sample.

    At most ``docs_per_label`` documents of each of the ``max_labels`` most frequent labels, those
    with the least hash of key and text, and of each ``words_per_doc`` words spread evenly over its whole text.
    """
    known = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    counts = known.groupBy(F.col(label).alias("label")).count().orderBy(F.desc("count"), "label").limit(max_labels)
    labels = sorted(r["label"] for r in counts.collect())
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "key"))  # a task sends docs_per_label rows per label
    rows = known.filter(F.col(label).isin(labels)).select(
        F.col(label).alias("label"), F.xxhash64(key, text).alias("h"), F.col(key).alias("key"),
        F.split(F.lower(F.trim(F.col(text))), r"\s+").alias("words"),
    )
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(words_per_doc - 1)),
        lambda i: F.get(F.col("words"), F.floor(i * F.size("words") / words_per_doc).cast("int")),
    )
    some = rows.select("label", "h", "key", F.when(F.size("words") > words_per_doc, spread).otherwise(F.col("words")).alias("words"))
    some = some.withColumn("rank", rank).filter(F.col("rank") <= docs_per_label).drop("rank")
    words, targets = [], []
    for r in sorted(some.collect(), key=lambda r: (r["label"], r["h"])):
        mine = [w for w in r["words"] if w]
        words += mine
        targets += [labels.index(r["label"])] * len(mine)
    return labels, words, targets


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", docs_per_label: int = 300, words_per_doc: int = 100,
    max_labels: int = 256, hidden: int = 16, steps: int = 300, batch: int = 256, rate: float = 0.02, seed: int = 5,
) -> tuple[list[str], BiGru | None]:
    """Labels and the trained network; no labels and None when there is nothing to learn from."""
    labels, words, targets = training_words(docs, key, text, label, docs_per_label, words_per_doc, max_labels)
    if not words:
        return [], None
    rng = np.random.default_rng(seed)
    units, mask, owner = units_of(words)
    model = BiGru.new(hidden, len(labels), rng)
    model.train(units, mask, np.array(targets)[owner], steps, batch, rate, rng)
    return labels, model


def predict(docs: DataFrame, labels: list[str], model: BiGru | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``, lang_pred and score.

    The recurrence starts anew at white space and after ``UNIT_BYTES`` bytes, so a word has the same
    position labels wherever it occurs and is run once as long as it is remembered. A document's
    probabilities are the normalised geometric mean of those of all its positions; score is that of
    the label chosen (ties: the first label in order). Null texts and texts without a letter are
    ``und`` with score 0, and so is everything without a model. Only ``text`` is looked at. Columns of ``docs``
    called lang_pred or score are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((0, len(labels) + 1))
        known: dict[str, int] = {}

        def pooled(texts: list[list[str]]) -> list[np.ndarray]:
            nonlocal table
            if len(known) > CACHE_WORDS:
                known.clear()
                table = table[:0]
            new, rows = [], []
            for words in texts:
                for w in words:
                    if w not in known:
                        known[w] = len(known)
                        new.append(w)
                rows.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            if new:
                table = np.concatenate([table, word_scores(model, new)])
            return [table[r].sum(axis=0) for r in rows]

        for batch in batches:
            preds: list[str] = []
            scores: list[float] = []
            held: list[list[str]] = []
            waiting = 0

            def flush() -> None:
                for total, words in zip(pooled(held), held):
                    if not words:
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    mean = total[:-1] / total[-1]
                    p = np.exp(mean - mean.max())
                    preds.append(labels[int(p.argmax())])
                    scores.append(float(p.max() / p.sum()))
                held.clear()

            for value in batch.column(at):
                s = value.as_py() or ""
                words = s.lower().split() if model is not None and any(map(str.isalpha, s)) else []
                held.append(words)
                waiting += len(words)
                if waiting >= CHUNK_WORDS:
                    flush()
                    waiting = 0
            flush()
            found = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )
            for lo in range(0, found.num_rows, BATCH_ROWS):
                yield found.slice(lo, BATCH_ROWS)

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(frugal(run), schema)
