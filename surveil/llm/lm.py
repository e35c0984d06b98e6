"""Language-model scoring: the marginal probability of a text over all its segmentations into vocabulary pieces."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.llm.shared import written

BLOCK_WORDS = 4_000_000  # words that share a vocabulary of their own
OUT_ROWS = 65_536
SPACE = 0x20  # stands for the sign of a word's beginning; no word contains it
GATHER_ROWS = 200_000  # words of several batches that are looked at together
PLAIN_BYTES = 24  # a byte weighs 1e-10 or more, so these products stay in range


def vocabulary(path: str) -> list[tuple[bytes, float]]:
    """(piece, log weight) of a SentencePiece file's vocabulary, every single byte included.

    The file's score of a merged piece is minus its rank; weights fall with the rank as
    1 / (rank + 2). Pieces with capital A-Z cannot occur in lower-cased text and are left out, and
    so are pieces with a word's beginning inside. Bytes that are no piece weigh as the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    sign = "▁"
    found: dict[bytes, float] = {}
    last = model.get_piece_size()
    for i in range(last):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or sign in piece[1:]:
            continue
        raw = piece.encode()
        if piece.startswith(sign):
            raw = bytes([SPACE]) + piece[1:].encode()
        if raw == raw.lower():
            found.setdefault(raw, -float(np.log(min(-model.get_score(i), last) + 2)))
    for b in range(256):
        found.setdefault(bytes([b]), -float(np.log(last + 2)))
    return sorted(found.items())


@lru_cache(maxsize=2)
def trie(pieces: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' prefixes as states: the next state for each byte (0 for none; 0 is the root), and the piece of each (-1 for none)."""
    prefixes = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)})
    state = {b"": 0} | {p: i for i, p in enumerate(prefixes, 1)}
    after = np.zeros((len(state), 256), np.int32)
    for p in prefixes:
        after[state[p[:-1]], p[-1]] = state[p]
    piece = np.full(len(state), -1, np.int32)
    for i, p in enumerate(pieces):
        piece[state[p]] = i
    return after.ravel(), piece


@dataclass
class Lattice:
    """The vocabulary's pieces and their log probabilities. The trie is made once in each worker."""

    pieces: tuple[bytes, ...]
    logp: np.ndarray

    def arcs(self, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """The pieces in words of one length, ``chars`` (words, bytes): (begin, end, words, pieces), by begin."""
        after, piece_of = trie(self.pieces)
        n, length = chars.shape
        columns = np.ascontiguousarray(chars.T).astype(np.int32)
        for begin in range(length):
            rows, state = np.arange(n), np.zeros(n, np.int32)
            for end in range(begin + 1, length + 1):
                state = after[(state << 8) + columns[end - 1][rows]]
                alive = np.flatnonzero(state)
                if len(alive) < len(rows):
                    rows, state = rows[alive], state[alive]
                if not len(rows):
                    break
                piece = piece_of[state]
                whole = np.flatnonzero(piece >= 0)
                if len(whole) == len(rows):
                    yield begin, end, rows, piece
                elif len(whole):
                    yield begin, end, rows[whole], piece[whole]

    def forward(self, chars: np.ndarray) -> np.ndarray:
        """Log weight of all ways to reach each place, (bytes + 1, words); the last row is the marginal."""
        n, length = chars.shape
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        for begin, end, rows, piece in self.arcs(chars):
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[begin, rows] + self.logp[piece])
        return alpha

    def expected(self, chars: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words, by the forward and backward recursions.

        In plain weights, which takes no logarithms, for words short enough to stay in range.
        """
        n, length = chars.shape
        arcs = list(self.arcs(chars))
        plain = length <= PLAIN_BYTES
        weight = np.exp(self.logp) if plain else self.logp
        join, pass_on = (np.add, np.multiply) if plain else (np.logaddexp, np.add)
        none, whole = (0.0, 1.0) if plain else (-np.inf, 0.0)
        alpha, beta = np.full((length + 1, n), none), np.full((length + 1, n), none)
        alpha[0] = beta[length] = whole
        for begin, end, rows, piece in arcs:
            alpha[end, rows] = join(alpha[end, rows], pass_on(alpha[begin, rows], weight[piece]))
        out = np.zeros(len(self.logp))
        for begin, end, rows, piece in reversed(arcs):
            on = pass_on(weight[piece], beta[end, rows])
            beta[begin, rows] = join(beta[begin, rows], on)
            share = pass_on(alpha[begin, rows], on)
            share = share / alpha[length, rows] if plain else np.exp(share - alpha[length, rows])
            out += np.bincount(piece, share, len(out))
        return out


def by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, bytes) of the words of each length, each word with its beginning sign."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        size = int(sizes[rows[0]])
        chars = np.empty((len(rows), size + 1), np.uint8)
        chars[:, 0] = SPACE
        chars[:, 1:] = data[offsets[rows][:, None] + np.arange(size)]
        yield rows, chars


def document(logp: np.ndarray, ids: np.ndarray, end: float, strength: float) -> float:
    """Log probability of a text with words ``ids``, marginal over word distributions around the corpus's.

    Each text draws its own word distribution from a Dirichlet with the corpus's probabilities as mean
    and ``strength`` pseudo-words. The product over words then is that of (strength * p + times seen so far
    in the text) / (strength + words so far). Infinite strength is the corpus distribution itself.
    """
    if not np.isfinite(strength):
        return float(logp[ids].sum() + end)
    n = len(ids)
    places = np.argsort(ids, kind="stable")
    run = ids[places]
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if n else np.zeros(0, np.int64)
    seen = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
    words = np.logaddexp(np.log(strength) + logp[run], np.log(np.maximum(seen, 1e-300)))
    return float(words.sum() - np.log(strength + np.arange(n + 1)).sum() + np.log(strength) + end)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in larger batches, so that there are many words of each length."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHER_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


TOKENS = "block long, idx int, word binary, n_train long, key {key}, held_out boolean, n_words long, ids binary"


def tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Words and texts of blocks: a row per distinct word of a block, then a row per text with its words as numbers in the block.

    A block is a run of whole texts of one task with ``BLOCK_WORDS`` words; its vocabulary says each word once,
    which is what the corpus statistics shuffle instead of every word of every text.
    """
    kind = docs.schema[key].dataType.simpleString()
    bucket = F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 7
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(bucket == 2, F.lit(True)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        key_type = None
        block = TaskContext.get().partitionId() << 24
        keys: list = []
        held: list[bool] = []
        ids: list[np.ndarray] = []

        def out(n: int, **columns: pa.Array) -> pa.RecordBatch:
            types = {
                "block": pa.int64(), "idx": pa.int32(), "word": pa.binary(), "n_train": pa.int64(), "key": key_type,
                "held_out": pa.bool_(), "n_words": pa.int64(), "ids": pa.binary(),
            }
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in types.items()], names=list(types))

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            learned = [a for a, h in zip(ids, held) if not h]
            train = np.bincount(np.concatenate(learned), minlength=len(numbers)) if learned else np.zeros(len(numbers), np.int64)
            words = list(numbers)
            for at in range(0, len(words), OUT_ROWS):
                part = words[at : at + OUT_ROWS]
                yield out(
                    len(part), block=pa.array(np.full(len(part), block)), idx=pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                    word=pa.array(part, pa.binary()), n_train=pa.array(train[at : at + len(part)].astype(np.int64)),
                )
            for at in range(0, len(ids), 1024):
                part = ids[at : at + 1024]
                yield out(
                    len(part), block=pa.array(np.full(len(part), block)), key=pa.array(keys[at : at + 1024], key_type),
                    held_out=pa.array(held[at : at + 1024], pa.bool_()), n_words=pa.array([len(a) for a in part], pa.int64()),
                    ids=pa.array([a.astype("<u4").tobytes() for a in part], pa.binary()),
                )
            numbers.clear()
            keys.clear()
            held.clear()
            ids.clear()
            block += 1

        waiting = 0
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t, h in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = (t.as_py() or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII alone
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                keys.append(k)
                held.append(h)
                waiting += len(words)
                if waiting >= BLOCK_WORDS:
                    yield from flush()
                    waiting = 0
        if ids:
            yield from flush()

    return rows.mapInArrow(run, TOKENS.format(key=kind))


def fit(words: DataFrame, vocab: list[tuple[bytes, float]], rounds: int = 2, floor: float = 0.01) -> Lattice:
    """Piece probabilities from the distinct training ``words`` (word): expectation maximisation from the vocabulary's own weights.

    Each distinct word counts once, since the pieces are to spell words that are rare or new. What
    comes to the driver is one number per piece of the vocabulary.
    """
    weights = np.array([w for _, w in vocab])
    pieces = tuple(p for p, _ in vocab)
    lattice = Lattice(pieces, weights - np.logaddexp.reduce(weights))
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], lattice: Lattice = lattice) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(lattice.logp))
            for batch in gathered(batches):
                for _, chars in by_length(batch.column(0)):
                    for at in range(0, len(chars), OUT_ROWS):
                        total += lattice.expected(chars[at : at + OUT_ROWS])
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "uses"])

        rows = words.select("word").mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses = np.full(len(pieces), floor)
        for r in rows:
            uses[r["piece"]] += r["uses"]
        lattice = Lattice(pieces, np.log(uses / uses.sum()))
    return lattice


@dataclass
class Model:
    """The whole lattice of a word: an arc that spans it, if it is known, and those of the pieces.

    The arc of a known word weighs its discounted relative frequency; what the discount frees is
    the weight of the way through the pieces.
    """

    lattice: Lattice
    tokens: int
    discount: float
    spelled: float  # weight of the ways through the pieces
    end: float  # log probability of a text's end

    @classmethod
    def of(cls, lattice: Lattice, tokens: int, distinct: int, once: int, twice: int, ends: int) -> Model:
        if not tokens:
            return cls(lattice, 1, 0.5, 0.5, float(np.log(0.5)))
        discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
        return cls(lattice, tokens, discount, discount * distinct / tokens, float(np.log(max(ends - discount, 0.1) / tokens)))

    def word(self, chars: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Log marginals of words of one length that were counted ``c`` times."""
        spelled = self.lattice.forward(chars)[-1] + np.log(self.spelled)
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(c - self.discount, 0) / self.tokens)
        return np.logaddexp(spelled, whole)


def score(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", rounds: int = 3, strength: float = 1000.0) -> DataFrame:
    """One row per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words are runs without ASCII white space, with A-Z lower-cased; a text is its words and an end. A
    piece never reaches over a word's beginning, so the lattice of a text is that of its words one
    after the other: the marginal of each distinct word is found once by the forward recursion
    in log space, and a text's score adds up those of its words and its end. The pieces are those of the
    file; their probabilities start from its scores and are fitted to all distinct training words. A
    word of the training texts is a piece too, weighed by its count (``Model``). Words add up as in
    ``document``: the corpus's probabilities are the mean of the text's own.

    Rows whose crc32(key as text) mod 7 is 2 are held out, and so are rows with a null key. Null
    texts are empty: an end alone. Repeated rows are rows of their own. No rows in, no rows out. Other columns
    are not read. Every distinct word has a segmentation, since each byte is a piece.
    """
    table = written(tokens(docs, key, text), "tokens")
    words = table.filter("word IS NOT NULL").select("block", "idx", "word", "n_train")
    texts = table.filter("ids IS NOT NULL").select("block", "key", "held_out", "n_words", "ids")
    ends = texts.filter("not held_out").count()
    # a word has a row per block at most, so no word is hot
    same = Window.partitionBy("word").orderBy("block")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = words.select(
        "block", "idx", "word", F.sum("n_train").over(whole).alias("c"), (F.row_number().over(same) == 1).alias("first")
    )
    counted = written(counted, "counted")
    known = counted.filter("first and c > 0")
    n, v, once, twice = known.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    n, v = (n or 0) + ends, v + (ends > 0)
    model = Model.of(fit(known, vocabulary(vocabulary_path), rounds), n, v, once, twice, ends)
    end = model.end
    scored = counted.select("block", "idx", "c", "word").mapInArrow(
        lambda batches: _word_scores(batches, model), "block long, idx int, c long, logp double"
    )
    kind = docs.schema[key].dataType.simpleString()

    def finish(texts: pa.Table, words: pa.Table) -> pa.Table:
        at = words.column("idx").to_numpy()
        c, logp = np.zeros(len(at), np.int64), np.zeros(len(at))
        c[at] = words.column("c").to_numpy()
        logp[at] = words.column("logp").to_numpy()
        base = np.log10((c + 1) / (n + v + 1))
        base_end, known_end = np.log10((ends + 1) / (n + v + 1)), int(ends > 0)
        cols: list[list] = [[], [], [], []]
        for value in texts.column("ids"):
            ids = np.frombuffer(value.as_py(), "<u4")
            cols[0].append(len(ids) + 1)
            cols[1].append(int((c[ids] > 0).sum()) + known_end)
            cols[2].append(float(base[ids].sum() + base_end))
            cols[3].append(document(logp, ids, end, strength) / float(np.log(10)))
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        n_tokens, n_known, base_score, lattice_score = (pa.array(x, t) for x, t in zip(cols, types))
        return pa.table(
            [texts.column("key"), texts.column("held_out"), n_tokens, n_known, pa.array(np.full(len(texts), n, np.int64)), base_score, lattice_score],
            names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    out = texts.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(
        finish, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnRenamed("key", key)


def _word_scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Rows of one word lie together, as the window that counted them left them: a word is run once for all its blocks in a batch."""
    for batch in gathered(batches):
        coded = batch.column(3).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary
        c = np.zeros(len(words), np.int64)
        c[at] = batch.column(2).to_numpy(zero_copy_only=False)
        logp = np.zeros(len(words))
        for rows, chars in by_length(words):
            for lo in range(0, len(rows), OUT_ROWS):
                part = rows[lo : lo + OUT_ROWS]
                logp[part] = model.word(chars[lo : lo + OUT_ROWS], c[part])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(logp[at])], names=["block", "idx", "c", "logp"])
