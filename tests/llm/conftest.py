import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa la mu nu xi".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, near copies and repeated rows; a third are one text."""
    rng = random.Random(4)
    base = words(rng, 60)
    rows = [(i, base, "en", "hot", 1) for i in range(0, 24)]
    for i in range(24, 32):  # near copies
        w = base.split()
        w[rng.randrange(60)] = "changed"
        rows.append((i, " ".join(w), "en", "hot", None))
    rows += [(i, words(rng, rng.randrange(1, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 3) for i in range(32, 60)]
    rows += [
        (60, None, "en", "a", 0), (61, "", "en", "a", 0), (62, " \n\t ", None, None, None), (63, "Übung\u00a0 ß 東京 😀", "de", "b", 7),
        (64, words(rng, 9000), "en", "a", 1), (65, "x" * 5000, "en", "a", 1), (66, "One two three four", "en", "a", 1),
        (67, "ONE  two\nthree four", "en", "a", 1), (68, "12 34 !!", "en", None, 1), (None, words(rng, 30), "en", "a", 1), (None, None, None, None, None),
        (70, "same row", "en", "a", 1), (70, "same row", "en", "a", 1), (71, "\\N </turn> ### User: ", "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in ("key", "size", "ref", "shard", "cell", "score", "length", "block", "word", "sig", "rank")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
