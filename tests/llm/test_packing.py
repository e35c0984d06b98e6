import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surveil.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "Σας ΟΔΟΣ", "J\u030c a", "it's DON'T ''s 's", "日本語 text x²½", "<|endoftext|> a", "<|ENDOFTEXT|> a", "a\x1cb c\u00a0d", "", "  \n\n x",
    "ÀÉ é\u0301 Å \u212a", "😀😀 ok!!?? 12ab34", "İstanbul", "tab\tand\r\nline\u2028end",
]


def test_ids_are_the_tokenizers():
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for got, text in zip(words.encode(ODD * 2), ODD * 2):
        assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_words_are_forgotten_and_come_back(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 7)
    rng = random.Random(4)
    vocabulary = [f"{rng.choice(['word', 'Été', 'x.', 'don', '東'])}{rng.randrange(30)}" for _ in range(60)]
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for _ in range(40):
        texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6))) for _ in range(3)] + [rng.choice(ODD)]
        for got, text in zip(words.encode(texts), texts):
            assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert len(words.words) < 60 and words.older


def test_each_distinct_word_is_looked_up_once():
    class Counted(dict):
        lookups = 0

        def __getitem__(self, key):
            Counted.lookups += 1
            return super().__getitem__(key)

    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    words.words = Counted()
    texts = ["one two three", "two don't one x2 two", "", "one " * 500, "<|endoftext|> one"]
    for got, text in zip(words.encode(texts), texts):
        assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert Counted.lookups <= 6  # one, two, three, don't, x2 and nothing, not the 513 words of the texts
    assert words.encode(["<|endoftext|>"]) == [np.asarray([49407], "<u4").tobytes()] and words.encode([]) == []


def test_a_worker_at_rest_holds_few_words(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    texts = ["one two three four", "don't one x2 five six"]
    for _ in range(3):
        for got, text in zip(words.encode(texts), texts):
            assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
        words.rest()
        assert len(words.words) <= 3 and not words.older and not words.parts


def test_pieces_of_words_are_those_of_the_tokenizer():
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for texts in (["foo bar été don't"], ["foo, bar. (foo) été; don't! foo-foo foo's"], ["foo, 12 foo12 bar."], ["foo; bar, 12, x² ; --"]):
        for got, text in zip(words.encode(texts), texts):
            assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert "foo" not in words.parts  # it is a word


def test_few_words_are_encoded_at_once(monkeypatch):
    monkeypatch.setattr(packing, "LINE_PARTS", 5)
    monkeypatch.setattr(packing, "LINES", 2, raising=False)

    class Watched:
        most = 0

        def __init__(self, own):
            self.own = own

        def encode_batch_fast(self, lines, **options):
            Watched.most = max(Watched.most, sum(len(x.split()) for x in lines))
            return self.own.encode_batch_fast(lines, **options)

    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    words.tokenizer = Watched(words.tokenizer)
    text = " ".join(f"{a}{b}{c} 東{a}{b}" for a in "abcd" for b in "efgh" for c in "ijkl")
    assert words.encode([text]) == [np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert 0 < Watched.most <= 10


def test_texts_encoded_together_are_few_bytes(monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_BYTES", 10)
    monkeypatch.setattr(packing, "CHUNK_TEXTS", 3)
    texts = pa.array(["aaaa", "bbbb", "cccc", None, "", "東東東東東東", "d", None, None, None, "e" * 10, "f"])
    found = list(packing.chunks(texts))
    assert found == [(0, 2), (2, 3), (5, 1), (6, 3), (9, 2), (11, 1)]
    assert list(packing.chunks(texts.slice(4))) == [(0, 1), (1, 1), (2, 3), (5, 2), (7, 1)]
    assert list(packing.chunks(pa.array([], pa.string()))) == []


def check(rows, texts, seq_len):
    plain = Tokenizer.from_file(PATH)
    bins = {}
    seen = []
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        seen.append((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= seq_len
    want = []
    for key, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for p, start in enumerate(range(0, len(ids), seq_len)):
            part = np.asarray(ids[start : start + seq_len], "<u4").tobytes()
            want.append((key, p, start, len(part) // 4, zlib.crc32(part)))
    assert sorted(map(str, seen)) == sorted(map(str, want))
    return len(bins), -(-sum(w[3] for w in want) // seq_len)


def test_odd_rows(odd, odd_rows, empty):
    docs = odd.drop("length", "piece")
    rows = packing.pack_documents(docs, PATH, 256).collect()
    made, bound = check(rows, [r[:2] for r in odd_rows], 256)
    assert bound <= made <= max(packing.best_fit([r["length"] for r in rows], 256)) + 2
    assert packing.pack_documents(empty, PATH).collect() == []


def test_kept_ids(odd):
    rows = packing.pack_documents(odd, PATH, 64, keep_ids=True).collect()
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


@pytest.mark.parametrize("low, high", [(1, 400), (600, 1400), (1100, 2047), (2048, 2048)])
def test_tree_is_as_good_as_one_best_fit(spark, low, high):
    rng = random.Random(low)
    lengths = [rng.randint(low, high) for _ in range(1500)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "i long, length long")
    rows = packing.pack(df, 2048, leaf_items=300, fan_in=3).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert all(o == sum(n for _, n in places[:i]) for i, (o, _) in enumerate(places)) and sum(n for _, n in places) <= 2048
    assert sorted(r["i"] for r in rows) == list(range(1500))
    whole = max(packing.best_fit(lengths, 2048)) + 1
    assert len(bins) <= whole * 1.03 + 2


def test_best_fit_takes_the_least_room():
    assert packing.best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
