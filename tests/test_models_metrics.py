import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.operators import metrics, ngram

V = 40


def rows(seed, n=40, size=12, hot=False):
    rng = random.Random(seed)
    pick = (lambda: 7 if rng.random() < 0.6 else rng.randint(5, V - 1)) if hot else (lambda: rng.randint(5, V - 1))
    return [[pick() for _ in range(size)] for _ in range(n)]


def frame(spark, data, batch=8):
    made = [(i, i // batch, r) for i, r in enumerate(data)]
    return spark.createDataFrame(made, "chunk_id bigint, batch_id bigint, input_ids array<int>")


def causal_model(train, test, k):
    pairs = Counter((r[i - 1], r[i]) for r in train for i in range(1, len(r)))
    heads = Counter(h for h, _ in pairs.elements())
    return [[-math.log((pairs[r[i - 1], r[i]] + k) / (heads[r[i - 1]] + k * V)) for i in range(1, len(r))] for r in test]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("share", [4, 8192])
def test_causal_losses(spark, monkeypatch, hot, share):
    """The same losses whether contexts are broadcast as frequent, shuffled as rare, or both."""
    monkeypatch.setattr(ngram, "HOT_SHARE", share)
    train, test = rows(1, hot=hot), rows(2, 20, hot=hot)
    model = ngram.fit_causal(frame(spark, train), V, 0.1)
    batches = materialize(frame(spark, test), "b")
    got = metrics.batch_losses(ngram.score_causal(batches, model, ["batch_id"]), batches).orderBy("batch_id").collect()
    want = causal_model(train, test, 0.1)
    assert [r["n_rows"] for r in got] == [8, 8, 4]
    for r in got:
        flat = [x for row in want[r["batch_id"] * 8 : r["batch_id"] * 8 + 8] for x in row]
        assert r["n_pred"] == len(flat)
        assert r["loss"] == pytest.approx(sum(flat) / len(flat))


def back_off_p(train, width):
    """p(w | u, h) from the definition: discounted counts, and the lower order over distinct left contexts."""
    tri = Counter()
    for r in train:
        e = [-1, *r]
        tri.update((e[i - 2], e[i - 1], e[i]) for i in range(2, len(e)))
    pair, token = Counter((h, w) for _, h, w in tri), Counter(w for _, w in {(h, w) for _, h, w in tri})

    def discount(counts):
        n1, n2 = (sum(n == k for n in counts.values()) for k in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 else 0.5

    def level(counts, context, w, lower):
        own = {k: n for k, n in counts.items() if k[: len(context)] == context}
        total = sum(own.values())
        if not total:
            return lower
        d = discount(counts)
        return max(own.get((*context, w), 0) - d, 0) / total + d * len(own) / total * lower

    def p(u, h, w):
        p1 = level({(t,): n for t, n in token.items()}, (), w, 1 / width)
        return level(tri, (u, h), w, level(pair, (h,), w, p1))

    return p


@pytest.mark.parametrize("hot", [False, True])
def test_trigram_losses(spark, hot):
    train, test = rows(1, hot=hot) + [[7], []], rows(2, 20, hot=hot) + [[38, 39, 39, 38], [5]]
    model = ngram.fit_trigram(frame(spark, train), V)
    batches = materialize(frame(spark, test), "b")
    got = metrics.batch_losses(ngram.score_trigram(batches, model, ["batch_id"]), batches).orderBy("batch_id").collect()
    p = back_off_p(train, V)
    nll = [[-math.log(p(r[i - 2] if i > 1 else -1, r[i - 1], r[i])) for i in range(1, len(r))] for r in test]
    assert [r["n_rows"] for r in got] == [8, 8, 6]
    for r in got:
        flat = [x for row in nll[r["batch_id"] * 8 : r["batch_id"] * 8 + 8] for x in row]
        assert (r["n_pred"], r["loss"]) == (len(flat), pytest.approx(sum(flat) / len(flat)))


def test_trigram_probabilities_sum_to_one(spark):
    """For contexts that were seen, of which only the last token was seen, and that were not seen at all."""
    train = rows(3, 30)
    model = ngram.fit_trigram(frame(spark, train), V)
    seen = (train[0][0], train[0][1])
    contexts = [seen, (-1, train[1][0]), (39, train[0][1]), (2, 3)]
    asked = [(u, h, w) for u, h in contexts for w in range(V)]
    df = spark.createDataFrame(asked, "u int, h int, w int")
    sums = ngram.trigram_nll(df, model).groupBy("u", "h").agg(F.sum(F.exp(-F.col("nll"))).alias("p")).collect()
    assert len(sums) == len(contexts) and all(r["p"] == pytest.approx(1) for r in sums)


def test_trigram_model_of_nothing(spark):
    model = ngram.fit_trigram(frame(spark, [[5], []]), V)
    df = frame(spark, [[5, 6, 7]])
    assert [r["nll"] for r in ngram.score_trigram(df, model, []).collect()] == [pytest.approx(math.log(V))] * 2


def test_losses_of_rows_in_any_order(spark):
    """Rows scored once give each batch order the losses of scoring its batches."""
    scored = spark.createDataFrame([(c, float(c + i)) for c in range(9) if c != 4 for i in range(1 + c % 3)], "chunk_id bigint, nll double")
    orders = [(e, c, (c * (e + 2)) % 9 // 4) for e in range(3) for c in range(9)] + [(3, 4, 0)]
    batches = spark.createDataFrame(orders, "epoch int, chunk_id bigint, batch_id bigint")
    want = metrics.batch_losses(batches.join(scored, "chunk_id"), batches, ["epoch"])
    got = metrics.losses_of_rows(metrics.row_losses(scored, ["chunk_id"]), batches, ["chunk_id"], ["epoch"])
    key = lambda r: (r["epoch"], r["batch_id"])
    assert [str(r) for r in sorted(got.collect(), key=key)] == [str(r) for r in sorted(want.collect(), key=key)]


@pytest.mark.parametrize(("accumulation", "every"), [(1, 1), (4, 5), (3, 2), (2, 100)])
def test_update_log(spark, accumulation, every):
    rng = random.Random(3)
    made = {(e, b): rng.random() for e in range(3) for b in range(11)}
    df = spark.createDataFrame([(e, b, x) for (e, b), x in made.items()], "epoch int, batch_id bigint, loss double")
    updates = [[made[e, b] for b in range(i, min(i + accumulation, 11))] for e in range(3) for i in range(0, 11, accumulation)]
    want = {}
    for step in range(every, len(updates) + 1, every):
        flat = [x for u in updates[step - every : step] for x in u]
        want[step] = pytest.approx(sum(flat) / len(flat))
    assert {r["step"]: r["mean_loss"] for r in metrics.update_log(df, accumulation, every).collect()} == want


def masked_p(train, k, weights=(0.4, 0.25, 0.25, 0.1)):
    both = Counter()
    for r in train:
        e = [-1, *r, -1]
        both.update((e[i - 1], e[i], e[i + 1]) for i in range(1, len(e) - 1))

    def total(match):
        return sum(n for key, n in both.items() if match(*key))

    def p(left, centre, right):
        parts = [
            (both[left, centre, right], total(lambda a, b, c: a == left and c == right)),
            (total(lambda a, b, c: a == left and b == centre), total(lambda a, b, c: a == left)),
            (total(lambda a, b, c: b == centre and c == right), total(lambda a, b, c: c == right)),
            (total(lambda a, b, c: b == centre), total(lambda *_: True)),
        ]
        return sum(w * (n + k) / (t + k * V) for w, (n, t) in zip(weights, parts))

    return p


def test_masked_losses_use_labels_and_corrupted_context(spark):
    train = rows(3, hot=True)
    model = ngram.fit_masked(frame(spark, train), V)
    test = [(0, 0, [7, 4, 9, 4], [-100, 8, -100, 7]), (1, 0, [4, 6], [5, -100]), (2, 1, [5, 6], [-100, -100])]
    df = spark.createDataFrame(test, "chunk_id bigint, batch_id bigint, input_ids array<int>, labels array<int>")
    got = metrics.batch_losses(ngram.score_masked(df, model, ["batch_id"]), df).orderBy("batch_id").collect()
    p = masked_p(train, 0.1)
    want = [-math.log(p(7, 8, 9)), -math.log(p(9, 7, -1)), -math.log(p(-1, 5, 6))]
    assert (got[0]["n_rows"], got[0]["n_pred"]) == (2, 3)
    assert got[0]["loss"] == pytest.approx(sum(want) / 3)
    # A batch with nothing to predict keeps its rows and has no mean.
    assert (got[1]["n_rows"], got[1]["n_pred"]) == (1, 0) and math.isnan(got[1]["loss"])


def test_masked_probabilities_sum_to_one():
    p = masked_p(rows(4, 10), 0.1)
    assert sum(p(7, c, 9) for c in range(V)) == pytest.approx(1)


def test_all_positions_and_real_positions(spark):
    model = ngram.fit_masked(frame(spark, rows(5)), V)
    df = spark.createDataFrame(
        [(0, [2, 7, 3, 0, 0], [1, 1, 1, 0, 0])], "batch_id bigint, input_ids array<int>, attention_mask array<int>"
    )
    scored = ngram.score_all_positions(df, model, ["batch_id"])
    assert scored.count() == 5
    assert scored.filter("is_real").count() == 3
    assert scored.filter("c = 0").count() == 2


LOSSES = [(0, 4, 2.0), (1, 4, 3.0), (2, 4, 1.5), (3, 4, 2.5), (4, 2, 6.0)]


def losses(spark, values=LOSSES):
    return spark.createDataFrame(values, "batch_id bigint, n_rows bigint, loss double")


def test_three_perplexities(spark):
    df = losses(spark)
    weighted = math.exp(sum(n * x for _, n, x in LOSSES) / sum(n for _, n, _ in LOSSES))
    repeated = [x for _, _, x in LOSSES for _ in range(4)][: sum(n for _, n, _ in LOSSES)]
    assert metrics.perplexity_weighted(df).first()[0] == pytest.approx(weighted)
    assert metrics.perplexity_gather(df, 4).first()[0] == pytest.approx(math.exp(sum(repeated) / len(repeated)))
    assert metrics.perplexity_gather(df, 4).first()[0] == pytest.approx(weighted)
    plain = math.exp(sum(x for *_, x in LOSSES) / len(LOSSES))
    assert metrics.perplexity_unweighted(df).first()[0] == pytest.approx(plain) != pytest.approx(weighted)


def test_perplexity_overflows_to_infinity(spark):
    df = losses(spark, [(0, 4, 710.0)])
    for value in (metrics.perplexity_weighted(df), metrics.perplexity_gather(df, 4), metrics.perplexity_unweighted(df)):
        assert value.first()[0] == math.inf


def test_perplexity_by_key(spark):
    df = losses(spark).withColumn("epoch", F.lit(1)).unionByName(losses(spark, [(0, 3, 1.0)]).withColumn("epoch", F.lit(2)))
    for value in (metrics.perplexity_gather(df, 4, ["epoch"]), metrics.perplexity_weighted(df, ["epoch"])):
        assert {r["epoch"]: r["perplexity"] for r in value.collect()}[2] == pytest.approx(math.e)


@pytest.mark.parametrize(("n", "every"), [(1, 100), (13, 5), (10, 1), (101, 100)])
def test_running_loss(spark, n, every):
    rng = random.Random(n)
    values = {(e, b): rng.random() for e in (0, 1) for b in range(n)}
    df = spark.createDataFrame([(e, b, x) for (e, b), x in values.items()], "epoch int, batch_id bigint, loss double")
    got = {(r["epoch"], r["batch_id"]): r["mean_loss"] for r in metrics.running_loss(df, every).collect()}
    assert set(got) == {(e, b) for e in (0, 1) for b in range(0, n, every)}
    for (e, b), mean in got.items():
        assert mean == pytest.approx(sum(values[e, i] for i in range(b + 1)) / (b + 1))
    assert {r["epoch"]: r["train_loss"] for r in metrics.epoch_loss(df).collect()}[0] == pytest.approx(
        sum(x for (e, _), x in values.items() if e == 0) / n
    )


def test_phase_loss_and_validation_log(spark):
    df = losses(spark).withColumn("epoch", F.lit(0))
    row = metrics.phase_loss(df.withColumn("phase", F.lit("test"))).first()
    assert (row["n_steps"], row["mean_loss"]) == (5, pytest.approx(3.0))
    steps = spark.createDataFrame([(0, 113)], "epoch int, step bigint")
    got = metrics.validation_log(df, steps, every=2).orderBy("batch_id").collect()
    assert [(r["step"], r["batch_id"]) for r in got] == [(113, 0), (113, 2), (113, 4)]
    assert all(r["perplexity"] == pytest.approx(math.exp(3.0)) for r in got)


@pytest.mark.parametrize("far", [9, (1 << 21) - 3, (1 << 21) - 2, (1 << 31) - 1])
def test_contexts_of_any_ids_meet_their_loss_by_one_number_if_they_fit_it(spark, capsys, far):
    places = [(0, ngram.EDGE, 5, far), (0, 5, far, 5), (1, far, 5, ngram.EDGE), (1, 5, far, 5), (2, 0, 0, 0)]
    positions = materialize(spark.createDataFrame(places, "batch_id int, l int, c int, r int"), "positions")
    asked = [(ngram.EDGE, 5, far, 1, 0.5), (5, far, 5, 2, 1.5), (far, 5, ngram.EDGE, 1, 2.5), (0, 0, 0, 1, 3.5)]
    nll = spark.createDataFrame(asked, "l int, c int, r int, seen bigint, nll double")
    met = ngram.attach_nll(positions, nll, ["l", "c", "r"])
    assert sorted(tuple(r) for r in met.collect()) == sorted((*p, {a[:3]: a[4] for a in asked}[p[1:]]) for p in places)
    met.explain()
    assert ("_key" in capsys.readouterr().out) == (far < (1 << 21) - 1)
