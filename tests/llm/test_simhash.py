import hashlib
import random

from pyspark.sql import functions as F

from surveil.llm import simhash


def test_edited_texts_and_next(odd, odd_rows):
    out = odd.select("doc_id", "text")
    unique = [r for r in odd_rows if r[0] is not None and r[0] != 70]
    docs = out.filter("doc_id is not null and doc_id <> 70")
    got = {r["doc_id"]: r for r in simhash.next_likeness(docs).collect()}
    order = sorted(unique, key=lambda r: -r[0])
    assert len(got) == len(order)
    prints = {}
    for i, (key, text, *_) in enumerate(order):
        a, b = text or "", order[(i + 1) % len(order)][1] or ""
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        r = got[key]
        assert r["n_chars"] == len(a) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(a, r["fingerprint"]) == r["fingerprint"]
        nxt = got[order[(i + 1) % len(order)][0]]
        apart = bin(int(r["fingerprint"], 16) ^ int(nxt["fingerprint"], 16)).count("1")
        assert r["near_next"] == 1 - apart / 128
    whole = simhash.next_likeness(odd).collect()
    assert len(whole) == len(odd_rows)


def test_cells_give_the_same(odd, monkeypatch):
    docs = odd.filter("doc_id is not null and doc_id <> 70")
    one = sorted(map(tuple, simhash.next_likeness(docs).collect()))
    monkeypatch.setattr(simhash, "CELL_ROWS", 5)
    assert sorted(map(tuple, simhash.next_likeness(docs).collect())) == one


def test_votes(spark):
    df = spark.createDataFrame([(1, "A b  c d\ne"), (2, None), (3, "one two"), (4, "ONE\ttwo")], "k int, text string")
    got = {r["k"]: r for r in simhash.fingerprints(df, ["k"]).collect()}
    assert got[2]["fingerprint"] == "0" * 32 and got[3]["fingerprint"] == got[4]["fingerprint"]
    terms = spark.createDataFrame([("a", "b", "c"), ("b", "c", "d"), ("c", "d", "e")], "x string, y string, z string")
    hashes = terms.select(*[F.xxhash64(F.lit(h), "x", "y", "z") for h in (0, 1)]).collect()
    for half, name in ((0, "high"), (1, "low")):
        want = sum(1 << b for b in range(64) if sum((r[half] >> b) & 1 for r in hashes) >= 2)
        assert got[1][name] % 2**64 == want


def test_search_against_all_pairs(spark):
    rng = random.Random(1)
    seeds = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(20)]
    prints = []
    for i in range(400):
        h, lo = rng.choice(seeds)
        for _ in range(rng.randrange(5)):
            b = rng.randrange(128)
            h, lo = (h ^ 1 << b, lo) if b < 64 else (h, lo ^ 1 << (b - 64))
        prints.append((i, h, lo))
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    df = spark.createDataFrame([(i, signed(h), signed(lo)) for i, h, lo in prints], "i int, high long, low long")
    got = {(r["high"], r["low"]): r["n_within"] for r in simhash.search(df, df.filter("i % 50 = 0"), radius=3).collect()}
    for i, h, lo in prints[::50]:
        want = sum(bin(h ^ a).count("1") + bin(lo ^ b).count("1") <= 3 for _, a, b in prints)
        assert got[signed(h), signed(lo)] == want


def test_empty_and_one_row(spark, empty):
    assert simhash.next_likeness(empty).collect() == []
    one = spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")
    r = simhash.next_likeness(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest()


def test_near_copies_are_within_the_registered_radius(spark):
    from surveil.llm.jaccard import WordHash, shingles
    from surveil.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    cache, sets = WordHash(), {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        if len(h := shingles(r["text"], cache)):
            sets[r["doc_id"]] = set(h.tolist())
    rows = {r["doc_id"]: r for r in QUERIES["op5_simhash"](spark, sf_dir).collect()}
    prints = {k: int(r["fingerprint"], 16) for k, r in rows.items()}
    keys = sorted(sets)
    pairs = {
        (a, b) for i, a in enumerate(keys) for b in keys[:i]
        if sets[a] != sets[b] and 3 * len(sets[a]) <= 4 * len(sets[b]) <= 5.34 * len(sets[a]) and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])
    }
    apart = [(prints[a] ^ prints[b]).bit_count() for a, b in pairs]
    assert len(apart) >= 12 and sum(d <= simhash.NEAR for d in apart) >= 0.9 * len(apart)
    for k, r in rows.items():
        want = sum((prints[k] ^ p).bit_count() <= simhash.NEAR for p in prints.values()) - 1 if k % 50 == 0 else None
        assert r["n_near"] == want


def test_search_at_a_large_radius_against_all_pairs(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(128) for _ in range(5)]
    prints = [rng.choice(seeds) ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(20))) for _ in range(400)]
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    df = spark.createDataFrame([(i, signed(p >> 64), signed(p % 2**64)) for i, p in enumerate(prints)], "i int, high long, low long")
    for radius in (0, 15, 23, 30):
        got = {(r["high"], r["low"]): r["n_within"] for r in simhash.search(df, df.filter("i % 20 = 0"), radius=radius).collect()}
        for p in prints[::20]:
            assert got[signed(p >> 64), signed(p % 2**64)] == sum((p ^ q).bit_count() <= radius for q in prints)
