import glob
import random

import pytest

from surveil.sources import writers

SCHEMA = "id int, a string, n double, b string"


@pytest.fixture
def small_parts(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def texts():
    rng = random.Random(1)
    fixed = [None, "", "\\N", "\\\\N", "\\n", "\\\n", "a\nb", "a\r\nb\r", "\\", "\\\\", "\\\\n\\\r\n\\", '"', '""x,', "  lead ", "\x85z ", "\x00q", "\\0", "#c", ",", "'", "é\t😀", "\n"]
    return fixed + ["".join(rng.choice('\\\n\rnN0", rx\0') for _ in range(rng.randrange(12))) for _ in range(4000)]


def test_one_file_read_by_several_tasks_comes_back_exactly(small_parts, tmp_path):
    spark, path = small_parts, str(tmp_path / "t")
    data = [(i, t, None if i % 3 else i / 7, u) for i, (t, u) in enumerate(zip(texts(), texts()[::-1]))]
    writers.write_lines(spark.createDataFrame(data, SCHEMA).coalesce(1), path)
    assert len(glob.glob(f"{path}/*.csv")) == 1
    read = writers.read_lines(spark, path, SCHEMA)
    assert read.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, read.collect())) == data


def test_a_record_is_a_line(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(i, t, 0.5, t) for i, t in enumerate(texts())]
    writers.write_lines(spark.createDataFrame(data, SCHEMA).coalesce(1), path)
    with open(glob.glob(f"{path}/*.csv")[0], newline="", encoding="utf-8") as f:
        body = f.read()
    assert body.count("\n") == len(data) + 1 and "\r" not in body and body.startswith('"id","a"')


def test_long_texts_and_no_rows(spark, tmp_path):
    long = "line\n" * 200_000
    writers.write_lines(spark.createDataFrame([(1, long, 0.0, None)], SCHEMA), str(tmp_path / "a"))
    assert writers.read_lines(spark, str(tmp_path / "a"), SCHEMA).first()["a"] == long
    writers.write_lines(spark.createDataFrame([], SCHEMA), str(tmp_path / "b"))
    assert writers.read_lines(spark, str(tmp_path / "b"), SCHEMA).collect() == []
