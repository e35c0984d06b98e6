"""Exact Jaccard join of word shingle sets by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.llm.shared import components, frugal, shared_folder, written
from surveil.operators.joins import skew_join
from surveil.operators.ordering import number_rows

SHINGLE = 5
LOW, HIGH = 75, 100  # the least similarity as a fraction
CACHE_WORDS = 200_000
SEEN_SETS = 250_000
BATCH_VALUES = 100_000  # hashes or signatures that a task hands on at once
FIRST_BAND, BAND_RATIO, PARTS_PER_ROW = 64, 8, 8
EXTRA = 0.15  # signatures beyond the least number, as a share of the set's size
BROADCAST_ROWS = 500_000  # of 8 bytes
BLOCK_SETS = 512  # compared with as many in one place
K = [np.uint64(k) for k in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * K[3]
    h = (h ^ (h >> np.uint64(29))) * K[1]
    return h ^ (h >> np.uint64(32))


class WordHash(dict):
    """A word's 64-bit hash, remembered; emptied when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, cache: WordHash, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's word shingles; of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII alone
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    width = min(n, size)
    out = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        out = (out + h[i : n - width + 1 + i]) * K[i % len(K)]
    return np.unique(mix(out))


def band(n: int) -> int:
    """0 for sets of fewer than 64 shingles; then one band for each factor of 8."""
    level, bound = 0, FIRST_BAND
    while n >= bound and level < 7:
        level, bound = level + 1, bound * BAND_RATIO
    return level


def least(n: int) -> int:
    """The largest n of a partner is n * 4 / 3, the smallest this."""
    return -(-n * LOW // HIGH)


def extra(n: int) -> int:
    return int(EXTRA * n) + 1


def needed(n: int) -> int:
    """Signatures that a set shares with any linked one, at least."""
    return extra(least(n))


def signatures(h: np.ndarray, level: int) -> np.ndarray:
    """PartEnum signatures of a set in a band, in the global order of their hashes.

    The shingle domain is cut into parts, their number fixed by the band; a signature is a part with
    all of the set's shingles in it. Sets that link differ in at most a third of the smaller one,
    n / 3 shingles, so in at most that many parts, and share all other parts that are not empty.
    The first n / 3 + ``extra`` signatures in one global order then share at least ``extra`` of the
    smaller set. In band 0 each shingle is a part.
    """
    n = len(h)
    if level:
        parts = FIRST_BAND * BAND_RATIO ** (level - 1) * PARTS_PER_ROW
        part = (((h * K[4]) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part)
        part = part[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums = np.add.reduceat(mix(h[order] + K[5]), starts)
        sig = mix(sums + part[starts] * K[0] + np.uint64(level) * K[2])
    else:
        sig = mix(h + K[2])
    keep = n // 3 + extra(n)
    if len(sig) < keep:
        if level:
            raise ValueError("too many empty parts; change the constants of the domain hash")
        return sig
    return np.partition(sig, keep - 1)[:keep]


def levels(n: int) -> list[int]:
    """A set's own band, and the one below if a smaller partner may be in it."""
    own = band(n)
    return [own, own - 1] if own and band(least(n)) < own else [own]


def _digest(h: np.ndarray) -> int:
    import xxhash

    return int(np.array(xxhash.xxh3_64_intdigest(h.tobytes()) & ~7, np.uint64).view(np.int64))


def set_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over the texts: (sig, ref, doc), a row per row of ``docs`` and a row per signature.

    A row's own has doc (key, text_hash, n: shingles) and ref, the name of its set, null without shingles; sig only
    deals it out. A signature's has no doc; ref's last three bits are the band. A task says the signatures of each set once.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = WordHash(), set()
        sigs: list[np.ndarray] = []
        refs: list[np.ndarray] = []
        waiting, doc_type = 0, None

        def out() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (sigs, refs)]
            sigs.clear()
            refs.clear()
            return pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(arrays[0]), doc_type)], names=["sig", "ref", "doc"])

        for batch in batches:
            sizes, names = [], []
            doc_type = pa.struct([("key", batch.schema.field(0).type), ("text_hash", pa.int64()), ("n", pa.int64())])
            for value in batch.column(2):
                h = shingles(value.as_py(), cache)
                sizes.append(len(h))
                names.append(ref := _digest(h) if len(h) else None)
                if ref is None or ref in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(ref)
                for level in levels(len(h)):
                    s = signatures(h, level)
                    sigs.append(s.view(np.int64))
                    refs.append(np.full(len(s), ref + level))
                    waiting += len(s)
                if waiting >= BATCH_VALUES:
                    yield out()
                    waiting = 0
            doc = pa.StructArray.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["key", "text_hash", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(np.random.default_rng(len(batch)).integers(0, 2**62, len(batch))), pa.array(names, pa.int64()), doc], names=["sig", "ref", "doc"])
        if waiting:
            yield out()

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text))
    return rows.mapInArrow(frugal(run), f"sig long, ref long, doc struct<key: {kind}, text_hash: bigint, n: bigint>")


def shared_only(rows: DataFrame) -> DataFrame:
    """The distinct (sig, ref) whose sig has two or more refs. Rows stream through sorted; one is held back.

    Rows with a third column that is not null pass as they are.
    """
    extra = rows.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_sig, held_ref, held_shared = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        nothing = [pa.int8()] * len(extra)

        def out(sig: np.ndarray, ref: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(ref), *[pa.nulls(len(sig), t) for t in nothing]], names=["sig", "ref", *extra])

        for batch in batches:
            if extra:
                nothing = [batch.column(2).type]
                passing = batch.column(2).is_valid()
                if passing.true_count:
                    yield batch.filter(passing)
                    batch = batch.filter(batch.column(2).is_null())
            sig = np.concatenate([held_sig, batch.column(0).to_numpy(zero_copy_only=False)])
            ref = np.concatenate([held_ref, batch.column(1).to_numpy(zero_copy_only=False)])
            new = np.r_[True, (sig[1:] != sig[:-1]) | (ref[1:] != ref[:-1])][: len(sig)]
            sig, ref = sig[new], ref[new]
            if not len(sig):
                continue
            same = sig[1:] == sig[:-1]
            shared = np.r_[held_shared, same] | np.r_[same, False]
            yield out(sig[:-1][shared[:-1]], ref[:-1][shared[:-1]])
            held_sig, held_ref, held_shared = sig[-1:], ref[-1:], bool(shared[-1])
        if held_shared:
            yield out(held_sig, held_ref)

    return rows.repartition("sig").sortWithinPartitions("sig", "ref").mapInArrow(frugal(run), rows.schema)


def candidates(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """The sets (set, n, text_hash) that share as many signatures with others as any link needs; all others have no link."""
    by_row = sizes.select("set", "n", "text_hash", F.explode(F.array(*[F.col("set") + i for i in range(8)])).alias("ref"))
    need = F.floor((-F.floor(-F.col("n") * LOW / HIGH)) * EXTRA) + 1
    held = shared.groupBy("ref").agg(F.count("*").alias("held")).join(by_row, "ref").filter(F.col("held") >= need)
    return held.select("set", "n", "text_hash").distinct()


def clusters(sets: DataFrame) -> DataFrame:
    """(node, component): sets among which all links are, and the name of their cluster; sets that can have no link are left out.

    Signatures are now single shingles, those of the candidates. A linked set shares 75 of 100 of its
    shingles; sets that share fewer with all others together go. Of the others each keeps its rarest
    shared ones, all but 75 of 100 and one more, so that linked sets still meet in one. Sets that meet are one cluster.
    """
    single = sets.select(F.explode("hashes").alias("sig"), "ref")
    shared = written(shared_only(single), "shared-shingles")
    need = -F.floor(-F.col("n") * LOW / HIGH)
    held = shared.groupBy("ref").agg(F.count("*").alias("held")).join(sets.select("ref", F.size("hashes").alias("n")), "ref")
    held = held.withColumn("need", need).filter("held >= need").drop("held")
    rows = skew_join(shared, held, ["ref"])
    popular = rows.groupBy("sig").agg(F.count("*").alias("popular")).filter("popular > 1")
    rows = skew_join(rows, popular, ["sig"])
    all_of = Window.partitionBy("ref")  # of one set: as many rows as it has shingles
    rows = rows.withColumns({"left": F.count("*").over(all_of), "place": F.row_number().over(all_of.orderBy("popular", "sig"))})
    rows = written(rows.filter("place <= left - need + 1").select("sig", "ref"), "prefixes")
    lows = rows.groupBy("sig").agg(F.min("ref").alias("low"))
    met = skew_join(rows, lows, ["sig"]).filter("ref != low").select(F.col("ref").alias("a"), F.col("low").alias("b")).distinct()
    return components(met)


def sets_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(ref, hashes) of the ``wanted`` sets, from texts with their text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = WordHash(), set()
        refs: list[int] = []
        hashes: list[np.ndarray] = []
        waiting = 0

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(refs, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], names=["ref", "hashes"])
            refs.clear()
            hashes.clear()
            return found

        for batch in batches:
            for value in batch.column(1):
                h = shingles(value.as_py(), cache)
                ref = _digest(h)
                if ref not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(ref)
                    refs.append(ref)
                    hashes.append(h.view(np.int64))
                    waiting += len(h)
                if waiting >= BATCH_VALUES:
                    yield out()
                    waiting = 0
        if refs:
            yield out()

    few = wanted.count() <= BROADCAST_ROWS
    names = wanted.select("text_hash")
    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).join(
        F.broadcast(names) if few else names, "text_hash", "left_semi"
    )
    found = texts.mapInArrow(frugal(run), "ref long, hashes array<long>").groupBy("ref").agg(F.first("hashes").alias("hashes"))
    refs = wanted.select(F.col("set").alias("ref"))
    return found.join(F.broadcast(refs) if few else refs, "ref", "left_semi")


def connecting_links(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, text_hash, n_shingles, ref) of all rows, ref naming the set, and what was found among different sets: (ref, linked, other).

    A row without ``other``: the set has links of similarity 0.75 or more with other sets that have ``linked`` copies in
    all, within two blocks. A row with it: a link; these links connect all sets that a chain of links joins.

    PartEnum signatures say which sets can have links at all (``candidates``), and those sets' rarest
    shared shingles which of them can link (``clusters``). A cluster is cut into blocks of ``BLOCK_SETS`` by size, and
    each two blocks whose sizes allow a link are compared in one place, all their pairs exactly. So a set travels once
    for each such block, not for each pair or shared signature, pairs are never rows, and none is compared twice.
    """
    rows = written(shared_only(set_rows(docs, key, text)), "shared")
    sizes = rows.filter("doc is not null").select("doc.key", "doc.text_hash", F.col("doc.n").alias("n_shingles"), "ref")
    shared = rows.filter("doc is null").select("sig", "ref")
    classes = sizes.filter("ref is not null").groupBy(F.col("ref").alias("set")).agg(
        F.first("n_shingles").alias("n"), F.min("text_hash").alias("text_hash"), F.count("*").alias("copies")
    )
    classes = written(classes, "classes")
    found = written(candidates(shared, classes), "candidates")
    sets = written(sets_of(docs, text, found), "hashes")
    named = clusters(sets).select(F.col("node").alias("ref"), F.col("component").alias("name"))
    members = skew_join(named, classes.select(F.col("set").alias("ref"), "n", "copies"), ["ref"])
    folder = f"{shared_folder(docs.sparkSession)}/ordered-{uuid4().hex}"
    ordered = number_rows(members, ["name", "n", "ref"], folder)  # places in a cluster without a task for each
    starts = ordered.groupBy("name").agg(F.min("rownum").alias("first"))
    block = F.floor((F.col("rownum") - F.col("first")) / BLOCK_SETS).cast("int")
    placed = written(skew_join(ordered, starts, ["name"]).select("ref", "name", "copies", "n", block.alias("block")), "members")
    blocks = placed.groupBy("name", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    upper = blocks.select("name", F.col("block").alias("hi"), F.col("least").alias("hi_least"))
    both = skew_join(blocks, upper, ["name"]).filter((F.col("block") <= F.col("hi")) & (F.col("hi_least") * LOW <= F.col("most") * HIGH))
    both = both.select("name", F.col("block").alias("lo"), "hi", F.explode(F.array_distinct(F.array("block", "hi"))).alias("block"))
    rows = skew_join(skew_join(placed, both, ["name", "block"]), sets, ["ref"])
    compared = rows.groupBy("name", "lo", "hi").applyInArrow(_linked_in_blocks, "ref long, linked long, other long")
    return sizes, written(compared, "compared")


def _linked_in_blocks(table: pa.Table) -> pa.Table:
    """The links between the sets of two blocks, or of one, each credited to both ends with the other's copies, and links that connect them."""
    table = table.combine_chunks()
    refs, copies, block = (table.column(c).to_numpy() for c in ("ref", "copies", "block"))
    hashes = table.column("hashes").combine_chunks()
    n = hashes.value_lengths().to_numpy().astype(np.int64)
    _, ids = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
    starts = np.r_[0, np.cumsum(n)[:-1]].astype(np.int64)
    has = np.zeros(ids.max() + 1, np.int64)
    linked = np.zeros(len(refs), np.int64)
    name = np.arange(len(refs))  # of the part that links connect so far
    ends: list[tuple[int, int]] = []
    one = block.min() == block.max()
    for i in range(len(refs)):
        mine = ids[starts[i] : starts[i] + n[i]]
        has[mine] = 1
        common = np.add.reduceat(has[ids], starts)
        has[mine] = 0
        near = common * HIGH >= (n[i] + n - common) * LOW
        near &= (np.arange(len(refs)) != i) if one else (block != block[i])
        linked[i] = copies[near].sum()
        parts, at = np.unique(name[near], return_index=True)
        for part, j in zip(parts, np.flatnonzero(near)[at]):
            if part != name[i]:
                ends.append((refs[i], refs[j]))
                name[name == part] = name[i]
    some = linked > 0
    a, b = (np.array(x, np.int64) for x in zip(*ends)) if ends else (np.zeros(0, np.int64),) * 2
    counts = pa.table({"ref": pa.array(refs[some], pa.int64()), "linked": pa.array(linked[some], pa.int64()), "other": pa.nulls(int(some.sum()), pa.int64())})
    links = pa.table({"ref": pa.array(a), "linked": pa.nulls(len(a), pa.int64()), "other": pa.array(b)})
    return pa.concat_tables([counts, links])


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", count_links: bool = False) -> DataFrame:
    """One row per row: key, n_shingles, component_id, the smallest key reachable by links of similarity 0.75 or more,
    component (a name of the component itself, null without shingles) and text_hash (xxhash64 of the text).

    A text's set are its distinct shingles of five words (A-Z lower-cased, split at ASCII white space),
    with fewer words the whole sequence. Exact up to collisions of 64-bit hashes. Null texts and
    texts without words have no shingles and are linked with nothing. Equal sets are one set
    throughout. Repeated rows stay; null keys are never the smallest, and only rows all of whose
    component has null keys get null. No rows in, no rows out. Only ``key`` and ``text`` are read.

    With ``count_links`` also n_links: the other rows that a row has a link of similarity 0.75 or more with. A
    set links its own copies and counts a linked set by its copies.
    """
    sizes, compared = connecting_links(docs, key, text)
    named = components(compared.filter("other is not null").select(F.col("ref").alias("a"), F.col("other").alias("b")))
    own = sizes.filter("ref is not null").groupBy("ref").agg(F.min("key").alias("low"))
    own = own.join(named, F.col("ref") == F.col("node"), "left").withColumn("name", F.coalesce("component", "ref"))
    lowest = own.groupBy("name").agg(F.min("low").alias("component_id"))
    of_set = skew_join(own.select("ref", "name"), lowest, ["name"]).select("ref", "name", "component_id")
    if count_links:
        copies = sizes.filter("ref is not null").groupBy("ref").agg(F.count("*").alias("copies"))
        linked = compared.filter("other is null").groupBy("ref").agg(F.sum("linked").alias("linked"))
        of_set = skew_join(skew_join(of_set, copies, ["ref"]), linked, ["ref"], "left")
        of_set = of_set.withColumn("links", F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).drop("copies", "linked")
    out = skew_join(sizes, of_set, ["ref"], "left")
    component = F.when(F.col("ref").isNull(), F.col("key")).otherwise(F.col("component_id"))
    n_links = [F.coalesce("links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("name").alias("component"), "text_hash", *n_links)
