"""Best-fit packing of token pieces by hierarchical residual packing."""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.shared import frugal, written

CACHE_WORDS = 300_000  # in either generation
KEPT_WORDS = 50_000  # that a worker keeps after a task
CHUNK_TEXTS = 2000
CHUNK_BYTES = 2_000_000  # of texts that are encoded together
BATCH_TEXTS = 2000  # that a task gets at once
LINE_PARTS = 256
LINES = 32  # encoded together
BEYOND_LATIN = "\u0250"
LEAF_ITEMS = 4096  # pieces that a leaf of the tree packs
FAN_IN = 16  # nodes that meet in the next round
NEARLY_FULL = 32  # a bin with less room than this is emitted
PIECES = "doc_id {key}, piece int, start long, length long, ids_crc32 long, ids binary"


class WordIds:
    """Ids of words, remembered: a word's are those of its pre-tokens, and each distinct pre-token is encoded once.

    ``pattern`` is the tokenizer file's own split pattern. Without one, or for words beyond the
    Latin blocks, the word is encoded as it is. Pre-tokens are encoded many to a line; the last id of
    each bears the file's end-of-word suffix, which tells them apart again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        suffix = config["model"].get("end_of_word_suffix")
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        patterns = [s["pattern"]["Regex"] for s in steps if s.get("type") == "Split" and "Regex" in s.get("pattern", {})]
        lowers = '"Lowercase"' in json.dumps(config.get("normalizer"))
        self.pattern = regex.compile(patterns[0]) if len(patterns) == 1 and suffix and lowers else None
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.special_lower = [s.lower() for s in self.special]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # words as they were when there were too many; those met again come back
        self.parts: dict[str, bytes] = {}

    def prepared(self, text: str) -> str | None:
        """The text with blanks between its words, in lower case if that is what the file does first; None if it must be encoded as a whole."""
        if self.pattern is None:
            return None if any(s in text for s in self.special) else text.replace("\n", " ")
        lower = text.lower()
        if not text.isascii() and ("\u03a3" in text or not (is_normalized("NFC", text) and is_normalized("NFC", lower))):
            return None  # here lower case depends on neighbours, or the order of the steps matters
        if any(s in lower for s in self.special_lower):
            return None  # the tokenizer looks for these in the text as it is
        return lower.replace("\n", " ")

    def learn(self, new: list[str]) -> None:
        split: dict[str, list[str]] = {}  # a word without an entry is one pre-token
        plain, pieces = set(), set()
        if self.pattern is not None:
            findall = self.pattern.findall
            latin = max(map(max, filter(None, new)), default="") < BEYOND_LATIN
            for word in new:
                if latin or max(word, default="") < BEYOND_LATIN:
                    if word.isalpha():
                        plain.add(word)
                    else:
                        split[word] = parts = findall(word)
                        pieces.update(parts)
        known = {part: self.parts[part] for part in pieces if part in self.parts}
        known |= {part: self.words[part] for part in pieces if part in self.words and part.isalpha()}
        plain |= pieces
        line_parts = list(plain.difference(known))
        for at in range(0, len(line_parts), LINE_PARTS * LINES):
            lines = [line_parts[i : i + LINE_PARTS] for i in range(at, min(at + LINE_PARTS * LINES, len(line_parts)), LINE_PARTS)]
            for line, found in zip(lines, self.tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)):
                ids = np.asarray(found.ids, "<u4")
                cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                if len(cuts) == len(line):
                    raw, start = ids.tobytes(), 0
                    for part, cut in zip(line, cuts):
                        known[part] = raw[start:cut]
                        start = cut
        rest = list(plain.union(w for w in new if w not in split).difference(known))
        for at in range(0, len(rest), LINE_PARTS * LINES):
            some = rest[at : at + LINE_PARTS * LINES]
            for part, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[part] = np.asarray(found.ids, "<u4").tobytes()
        self.parts.update((part, known[part]) for part in pieces if not part.isalpha())
        ids_of = known.__getitem__
        for word in new:
            self.words[word] = b"".join(map(ids_of, split[word])) if word in split else known[word]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The texts' ids as little-endian bytes.

        Arrow splits the texts, numbers their distinct words and puts the words' ids in the texts' order, so
        Python looks up each distinct word of ``texts`` once.
        """
        if len(self.words) > CACHE_WORDS:
            self.words, self.older = {}, self.words
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        prepared = [self.prepared(t) for t in texts]
        split = pc.split_pattern(pa.array([t for t in prepared if t is not None], pa.large_string()), " ")
        numbered = split.flatten().dictionary_encode()
        own = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in own if w not in self.words]
        again = [w for w in new if w in self.older]
        self.words.update((w, self.older[w]) for w in again)
        if len(new) > len(again):
            self.learn([w for w in new if w not in self.older])
        ids = pa.array(list(map(self.words.__getitem__, own)), pa.large_binary()).take(numbered.indices)
        _, offsets, raw = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist() if len(ids) else []
        raw, spans = memoryview(raw or b""), zip(at, at[1:])
        out = []
        for text, words in zip(texts, prepared):
            if words is None:
                out.append(np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                start, stop = next(spans)
                out.append(bytes(raw[start:stop]))
        return out

    def rest(self) -> None:
        """After a task: only the words met first stay, the frequent ones among them; an idle worker holds no more."""
        self.words, self.older, self.parts = dict(islice(self.words.items(), KEPT_WORDS)), {}, {}


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of the texts that are encoded together: at most ``CHUNK_TEXTS``, and ``CHUNK_BYTES`` unless it is one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_BYTES, "right"))
        hi = min(max(hi, lo + 1), lo + CHUNK_TEXTS)
        yield lo, hi - lo
        lo = hi


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks that a worker process runs: the words that ``rest`` keeps are known in the next."""
    return WordIds(path)


def tokenize(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, with ``keep_ids``, ids (little-endian 32-bit).

    A text's ids are those of the tokenizer file, then ``end_id``. Longer ones are cut into
    ``seq_len`` ids. The pre-tokenizer of the file must never join over a blank or a line feed:
    then words have their ids on their own, and a word met before is not encoded again. A null
    or empty text has the end alone.
    """
    kind = docs.schema[key].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        words = word_ids(tokenizer_path)
        for batch in batches:
            schema = pa.schema([
                ("doc_id", batch.schema.field(0).type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                ("ids_crc32", pa.int64()), ("ids", pa.binary()),
            ])
            for lo, n in chunks(batch.column(1)):
                part = batch.slice(lo, n)
                rows: list[tuple] = []
                at: list[int] = []
                for i, encoded in enumerate(words.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids = encoded + end
                    for p, start in enumerate(range(0, len(ids), 4 * seq_len)):
                        own = ids[start : start + 4 * seq_len]
                        at.append(i)
                        rows.append((p, start // 4, len(own) // 4, zlib.crc32(own), own if keep_ids else None))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema
                )
        words.rest()

    return docs.select(F.col(key), F.col(text)).mapInArrow(frugal(pieces), PIECES.format(key=kind))


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Best fit decreasing: the bin number of each item.

    ``rooms`` are the distinct free spaces that occur, sorted; an item goes to a bin with the
    least room that holds it.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    rooms: list[int] = []
    with_room: dict[int, list[int]] = {}
    where = [0] * len(lengths)
    made = 0
    for i in order:
        size = lengths[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = with_room[room].pop()
            if not with_room[room]:
                del with_room[room], rooms[at]
        else:
            room, b, made = capacity, made, made + 1
        where[i] = b
        left = room - size
        if left:
            if left not in with_room:
                rooms.insert(bisect_left(rooms, left), left)
                with_room[left] = []
            with_room[left].append(b)
    return where


NODE = "node long, used long, bin_id long, done boolean, items array<struct<row:long,offset:long>>"


def _pack(table: pa.Table, capacity: int, fan_in: int) -> pa.Table:
    """One node's bins. A bin is an item of this round; merged bins keep their places one after the other.

    At most one of the new bins is at most half full, so only as many others can still be of use
    as small bins can meet in the next node: it passes on that one and the emptiest ``fan_in``.
    """
    node, used, ids, items = (table.column(c).to_pylist() for c in ("node", "used", "bin_id", "items"))
    where = best_fit(used, capacity)
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(where):
        bins.setdefault(b, []).append(i)
    rows = []
    for members in bins.values():
        at, placed = 0, []
        for i in members:
            placed += [{"row": x["row"], "offset": x["offset"] + at} for x in items[i]]
            at += used[i]
        rows.append([node[0] // fan_in, at, min(ids[i] for i in members), True, placed])
    open_rows = sorted((r for r in rows if capacity - r[1] >= NEARLY_FULL), key=lambda r: (r[1], r[2]))
    for r in open_rows[: fan_in + 1]:
        r[3] = False
    cols = list(zip(*rows)) or [[]] * 5
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.struct([("row", pa.int64()), ("offset", pa.int64())]))]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["node", "used", "bin_id", "done", "items"])


def pack(pieces: DataFrame, capacity: int = 2048, leaf_items: int = LEAF_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``pieces`` (with a ``length``) plus sequence_id and offset (gapless from 0 in a sequence).

    Hierarchical residual packing: pieces are dealt evenly into leaves and packed there by best
    fit; nearly full bins leave the tree; underfull bins are the items of the next node, where
    ``fan_in`` nodes meet, up to the root. A leaf holds about ``leaf_items`` pieces and an inner node
    at most ``fan_in`` * (``fan_in`` + 1) bins, whatever the input. Full pieces are bins of their own.

    ``length`` must be from 1 to ``capacity``. Equal and repeated rows are packed one by one. No
    rows in, no rows out. Columns sequence_id, offset and __row must not be there.
    """
    rows = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces", rows=BATCH_TEXTS)
    n = rows.filter(F.col("length") < capacity).count()
    leaves = -(-n // leaf_items) or 1
    level = rows.filter(F.col("length") < capacity).select(
        F.pmod(F.xxhash64("__row"), F.lit(leaves)).alias("node"), F.col("length").alias("used"), F.col("__row").alias("bin_id"),
        F.lit(False).alias("done"), F.array(F.struct(F.col("__row").alias("row"), F.lit(0).cast("long").alias("offset"))).alias("items"),
    )
    finished = []
    nodes = leaves
    while True:
        level = written(level.groupBy("node").applyInArrow(lambda t: _pack(t, capacity, fan_in), NODE), "bins")
        if nodes == 1:
            finished.append(level)
            break
        finished.append(level.filter("done"))
        level = level.filter("not done")
        nodes = -(-nodes // fan_in)
    places = finished[0]
    for more in finished[1:]:
        places = places.unionByName(more)
    places = places.select(F.col("bin_id").alias("sequence_id"), F.inline("items"))
    out = rows.join(places, F.col("__row") == F.col("row"), "left")
    return out.select(
        *pieces.columns, F.coalesce("sequence_id", "__row").alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``tokenize`` and ``pack``: one row per piece with its place in a sequence. Repeated documents are packed each."""
    pieces = tokenize(docs, tokenizer_path, seq_len, end_id, key, text, keep_ids)
    return pack(pieces if keep_ids else pieces.drop("ids"), seq_len)
