import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.functions import digests
from lexmill.functions.scratch import materialize
from lexmill.operators import batching, masking, splitting


def ids(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("chunk_id"))


@pytest.mark.parametrize(("n", "train", "test"), [(1, 1.0, 0.0001), (10, 0.9, 0.1), (10, 0.5, 0.1), (1000, 0.9, 0.1), (77, 0.3, 0.33)])
def test_split_sizes_and_members(spark, n, train, test):
    if n == 1:
        with pytest.raises(ValueError):
            splitting.split_exact(ids(spark, n), 0.9, 0.1)
        return
    got = splitting.split_exact(ids(spark, n), train, test, seed=7).collect()
    order = sorted(range(n), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    n_test, n_train = math.ceil(test * n), math.floor(train * n)
    assert {r["chunk_id"] for r in got if r["split"] == "test"} == set(order[:n_test])
    assert {r["chunk_id"] for r in got if r["split"] == "train"} == set(order[n_test : n_test + n_train])
    again = splitting.split_exact(ids(spark, n, 17), train, test, seed=7)
    assert sorted(again.collect()) == sorted(got)


@pytest.mark.parametrize(("train", "test"), [(0.9, 0.2), (0, 0.1), (0.9, -0.1), (1.5, 0.1)])
def test_split_rejects_bad_fractions(spark, train, test):
    with pytest.raises(ValueError):
        splitting.split_exact(ids(spark, 10), train, test)


def test_split_rejects_empty(spark):
    with pytest.raises(ValueError):
        splitting.split_exact(ids(spark, 10).filter("chunk_id < 0"), 0.9, 0.1)


def test_split_does_not_move_rows(spark):
    table = materialize(ids(spark, 500), "ids")
    plan = splitting.split_exact(table, 0.9, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_overlap_counts_rows_not_texts(spark):
    rows = [("a", "train")] * 50 + [("a", "test")] * 3 + [("b", "test"), ("c", "train"), (None, "test")]
    df = spark.createDataFrame(rows, "text string, split string").withColumn("digest", splitting.text_digest())
    row = splitting.train_eval_overlap(df).first()
    assert (row["n_eval"], row["n_overlap"], row["ratio"]) == (5, 3, 0.6)


def chunk_rows(spark, n=60, size=130):
    return spark.range(n).select(
        F.col("id").alias("chunk_id"),
        F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: ((F.col("id") * 31 + i * 7) % 500).cast("int")).alias("input_ids"),
    )


def mask_model(chunk_id, row, epoch, p, seed, size):
    out = []
    for i, token in enumerate(row):
        d = hashlib.md5(f"{seed}:{epoch}:{chunk_id}:{i // 4}".encode()).hexdigest()
        if token < 5 or int(d[(i % 4) * 8 :][:8], 16) >= round(p * 2**32):
            out.append((token, -100))
            continue
        own = hashlib.md5(f"{d}:{i % 4}".encode()).hexdigest()
        action = int(own[:8], 16)
        if action < round(0.8 * 2**32):
            out.append((4, token))
        elif action < round(0.9 * 2**32):
            out.append((int(own[8:16], 16) % size, token))
        else:
            out.append((token, token))
    return out


def test_masks_match_model_and_shares(spark):
    df = chunk_rows(spark)
    clean = {r["chunk_id"]: r["input_ids"] for r in df.collect()}
    got = masking.mask_static(df.repartition(11), 500, probability=0.2, seed=42).collect()
    n = chosen = masked = kept = 0
    for r in got:
        want = mask_model(r["chunk_id"], clean[r["chunk_id"]], -1, 0.2, 42, 500)
        assert list(zip(r["input_ids"], r["labels"])) == want
        for before, after, label in zip(clean[r["chunk_id"]], r["input_ids"], r["labels"]):
            n += before >= 5
            assert label == -100 or (before >= 5 and label == before)
            assert label != -100 or after == before
            chosen, masked, kept = chosen + (label != -100), masked + (label != -100 and after == 4), kept + (label == after)
    assert abs(chosen - 0.2 * n) < 5 * math.sqrt(n * 0.16)
    assert abs(masked - 0.8 * chosen) < 5 * math.sqrt(chosen * 0.16)
    assert abs(kept - 0.1 * chosen) < 5 * math.sqrt(chosen * 0.09)


def test_masks_change_with_the_epoch_only(spark):
    df = masking.repeat_epochs(chunk_rows(spark, 5), 3)
    one, two = (sorted(masking.mask_epochs(df.repartition(p), 500).select("epoch", "chunk_id", "labels").collect()) for p in (1, 6))
    assert one == two
    by_epoch = {e: [r["labels"] for r in one if r["epoch"] == e] for e in range(3)}
    assert by_epoch[0] != by_epoch[1] != by_epoch[2]


@pytest.mark.parametrize("p", [0.0, 1.0])
def test_mask_probability_ends(spark, p):
    df = spark.createDataFrame([(1, [2, 7, 8, 9, 10, 3])], "chunk_id bigint, input_ids array<int>")
    labels = masking.mask_static(df, 500, probability=p).first()["labels"]
    assert labels == ([-100] * 6 if p == 0 else [-100, 7, 8, 9, 10, -100])


def test_shuffled_batches(spark):
    rows = masking.repeat_epochs(ids(spark, 70), 2)
    got = batching.batch_shuffled(rows, 32, 42).collect()
    orders = {}
    for e in (0, 1):
        mine = sorted((r for r in got if r["epoch"] == e), key=lambda r: (r["batch_id"], r["pos_in_batch"]))
        assert [r["batch_id"] for r in mine] == [i // 32 for i in range(70)]
        assert [r["pos_in_batch"] for r in mine] == [i % 32 for i in range(70)]
        orders[e] = [r["chunk_id"] for r in mine]
        assert sorted(orders[e]) == list(range(70))
    assert orders[0] != orders[1]
    assert orders[0] == sorted(range(70), key=lambda i: hashlib.md5(f"42:0:{i}".encode()).hexdigest())


def test_sequential_batches_shards_and_budget(spark):
    gaps = ids(spark, 40).filter("chunk_id % 3 > 0").withColumnRenamed("chunk_id", "row_ord")
    got = batching.batch_sequential(gaps, 4, dense=False).orderBy("row_ord").collect()
    assert [r["batch_id"] for r in got] == [i // 4 for i in range(len(got))]
    sharded = batching.with_update_id(batching.shard_batches(batching.batch_sequential(ids(spark, 40), 4, "chunk_id"), 3), 2)
    assert all(r["shard"] == r["batch_id"] % 3 and r["update_id"] == r["batch_id"] // 2 for r in sharded.collect())
    row = batching.step_budget(ids(spark, 70), 32, 3, 2).first()
    assert tuple(row) == (70, 3, 9, 2)


def test_digests_are_those_of_hashlib():
    prefixes = [b"42:0:%d:" % i for i in (0, 5, 1 << 40)] + [b"x:", b"y" * 20]
    counts = np.array([1, 33, 1234, 0, 12])
    for last in (b"y" * 20, b"z" * 60):
        prefixes[4] = last
        want = [hashlib.md5(b"%s%d" % (p, n)).digest() for p, k in zip(prefixes, counts) for n in range(k)]
        got = digests.md5_numbered(prefixes, counts)
        assert got.tobytes() == b"".join(want)
        lanes = np.arange(len(got)) % 4
        again = [hashlib.md5(b"%s:%d" % (d.hex().encode(), k)).digest() for d, k in zip(want, lanes)]
        assert digests.md5_of_hex(got, lanes).tobytes() == b"".join(again)
    assert len(digests.md5_numbered([], np.zeros(0, np.int64))) == 0
