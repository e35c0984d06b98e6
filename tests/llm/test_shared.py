import pyarrow as pa

from surveil.llm import shared

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])


def test_rows_handed_to_python_while_written(spark):
    before = spark.conf.get(ROWS)
    df = spark.range(0, 100, 1, 2).mapInArrow(sizes, "n long")
    assert sorted(r["n"] for r in shared.written(df, "sizes", rows=20).collect()) == [10, 10, 20, 20, 20, 20]
    assert spark.conf.get(ROWS) == before
    assert sorted(r["n"] for r in shared.written(df, "sizes").collect()) == [50, 50]
    try:
        spark.conf.set(ROWS, 7)  # fewer than asked for
        assert max(r["n"] for r in shared.written(df, "sizes", rows=20).collect()) == 7
        assert spark.conf.get(ROWS) == "7"
    finally:
        spark.conf.set(ROWS, before)


def test_memory_is_given_back_when_a_task_has_ended(monkeypatch):
    said = []
    monkeypatch.setattr(shared, "give_back", lambda: said.append("back"))

    def run(batches):
        try:
            for batch in batches:
                said.append(batch)
                yield -batch
        finally:
            said.append("end")

    assert list(shared.frugal(run)(iter([1, 2]))) == [-1, -2]
    assert said == [1, 2, "end", "back"]


def test_rows_pass_a_frugal_task(spark):
    df = spark.range(0, 1000, 1, 3)
    assert df.mapInArrow(shared.frugal(lambda batches: batches), "id long").count() == 1000
    assert df.filter("id < 0").mapInArrow(shared.frugal(lambda batches: batches), "id long").count() == 0
