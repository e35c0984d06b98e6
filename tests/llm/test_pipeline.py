from collections import Counter

import corpus_pipeline
import public_tokenizers
from surveil.llm import mixing
from surveil.llm.queries import ORACLES, QUERIES
from surveil.llm.shared import components
from tests.llm.test_jaccard import components_of
from tests.llm.test_packing import check
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert [n.split("_")[0] for n in QUERIES if n != "pipeline"] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "deduplicate", "mix", "pack"]


def test_oracles(spark):
    con = connect(SF_DIR)
    for name, sql in ORACLES.items():
        assert difference(QUERIES[name](spark, SF_DIR), con, sql) is None, name


def test_stages_against_brute_force(spark, odd, odd_rows):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    rows = [r for r in odd_rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(map(tuple, kept.collect())) == Counter(rows)

    one = corpus_pipeline.deduplicate(spark, kept, "")
    assert one.columns == docs.columns
    keys = {k for k, _, c in components_of([r[:2] for r in rows]) if k == c and k is not None}
    got = one.collect()
    assert Counter(r["doc_id"] for r in got) == Counter({**dict.fromkeys(keys, 1), None: sum(r[0] is None for r in rows)})
    assert {tuple(r) for r in got} <= set(rows)

    mixed = corpus_pipeline.mix(spark, one, "")
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.mix_sources(one).collect():
        want[r["doc_id"], r["text"]] += 1
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == want

    packed = corpus_pipeline.pack(spark, mixed, "").collect()
    made, bound = check(packed, [(r["doc_id"], r["text"]) for r in mixed.collect()], 2048)
    assert made <= bound + 1


def test_run(spark):
    assert public_tokenizers.path("word_bpe_49k.json") == corpus_pipeline.WORD_BPE
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len(rows) > 100 and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_components_against_search(spark):
    import random

    rng = random.Random(3)
    edges = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 340)] + [(rng.randrange(400, 800), rng.randrange(400, 800)) for _ in range(250)]
    name = list(range(800))
    for a, b in edges:
        old, new = max(name[a], name[b]), min(name[a], name[b])
        name = [new if n == old else n for n in name]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: name[x] for x in ends}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_language_without_labels_keeps_texts_with_letters(spark):
    rows = [(1, "clean words"), (2, None), (3, ""), (4, "12 34 !!"), (5, "東京"), (6, "1\nß"), (7, "😀")]
    docs = spark.createDataFrame([(i, t, None, "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 5, 6]


def test_mix_takes_clashing_names(spark, odd):
    docs = odd.select("doc_id", "text", "source")
    clashing = docs.selectExpr("*", "'r' AS Rate", "'c' AS copy", "'s' AS shuffle_key")
    mixed = corpus_pipeline.mix(spark, clashing, "")
    assert mixed.columns == clashing.columns
    want = Counter((*r, "r", "c", "s") for r in corpus_pipeline.mix(spark, docs, "").collect())
    assert Counter(map(tuple, mixed.collect())) == want


def test_the_language_decides(spark):
    """Texts in a language that is labelled but not wanted go, whatever their own label says; clashing names come back as they were."""
    import random

    rng = random.Random(6)
    letters = {"en": "aeiostn", "fi": "kyäöukl", "de": "chßurgm"}

    def text(lang):
        return " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(40))

    rows = [(i, text(lang), lang if i < 300 else None, "a", 1, i, {"k": i}) for i in range(360) for lang in [rng.choice(list(letters))]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, hash map<string,int>"
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    kept = {r["doc_id"]: r for r in kept.collect()}
    wanted = {i for i, t, *_ in rows if not set(t) & set("kyäöl")}
    assert len(kept.keys() & wanted) > 0.97 * len(wanted) and len(kept.keys() - wanted) < 0.03 * (len(rows) - len(wanted))
    assert all(r["score"] == i and r["hash"] == {"k": i} for i, r in kept.items())


def test_deduplicate_takes_clashing_names_and_maps(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, "h", {"b": 2}), (1, text, "h", {"a": 1}), (2, text, "g", None), (3, "another text of some few words", "x", {"z": 9}), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, rows map<string,int>")
    out = corpus_pipeline.deduplicate(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["hash"], r["rows"]) for r in out.collect() if r["hash"]) == [(1, "h", {"a": 1}), (3, "x", {"z": 9})]
    assert {r["doc_id"] for r in out.collect()} == {1, 3, 4}
