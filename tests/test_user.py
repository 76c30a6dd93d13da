import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from lexmill.operators import batching, user


def test_map_batches_keeps_rows(spark):
    def double(batch):
        return pa.RecordBatch.from_arrays([pc.multiply(batch.column(0), 2)], names=["id"])

    got = user.map_batches(spark.range(100), double, "id bigint")
    assert sorted(r["id"] for r in got.collect()) == [2 * i for i in range(100)]


@pytest.mark.parametrize("parts", [1, 5])
def test_map_windows_sees_ordered_windows(spark, parts):
    rows = spark.range(25).select(F.col("id").alias("row_ord"), (F.col("id") * 10).alias("x")).repartition(parts)

    def ends(window):  # two rows from every window
        return window.select(["x"]).take(pa.array([0, window.num_rows - 1]))

    got = sorted(r["x"] for r in user.map_windows(rows, ends, "x bigint", 10).collect())
    assert got == [0, 90, 100, 190, 200, 240]


def test_collate_sees_whole_batches(spark):
    batches = batching.batch_sequential(spark.range(10).withColumnRenamed("id", "row_ord"), 4)

    def collate(batch):
        return pa.table({"batch_id": batch["batch_id"].slice(0, 1), "rows": pa.array([batch["row_ord"].to_pylist()])})

    got = user.collate_batches(batches, collate, "batch_id bigint, rows array<bigint>").orderBy("batch_id").collect()
    assert [r["rows"] for r in got] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
