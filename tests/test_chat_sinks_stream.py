import random
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexmill.functions import scratch
from lexmill.functions.scratch import materialize
from lexmill.operators import chat, ngram, vocab
from lexmill.plans import flows
from lexmill.sources import writers
from lexmill.streaming import rows as stream_rows

TURN = "conv_id bigint, turn bigint, role string, text string"


def turns():
    rng = random.Random(3)
    # One conversation holds most of the turns, with gaps between turn numbers.
    made = [(0, t, rng.choice(["system", "user", "assistant"]), f"t{t}") for t in sorted(rng.sample(range(9000), 600))]
    made += [(c, t, rng.choice(["user", "assistant"]), f"c{c}t{t}") for c in range(1, 30) for t in range(rng.randint(1, 6))]
    return made


@pytest.mark.parametrize("block", [4, 1024])
def test_pairs_follow_turn_order(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "TURN_BLOCK", block)
    made = turns()
    want = [
        (a[0], a[1], a[3], b[3])
        for a, b in zip(made, made[1:])
        if a[0] == b[0] and a[2] == "user" and b[2] == "assistant"
    ]
    df = spark.createDataFrame(made, TURN).repartition(7)
    assert sorted(tuple(r) for r in chat.turns_to_pairs(df).collect()) == sorted(want)
    assert chat.next_turn(df).count() == len(made)


@pytest.mark.parametrize("block", [4, 1024])
def test_full_conversations_keep_every_turn(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "TURN_BLOCK", block)
    made = turns()
    got = chat.chat_format_full(spark.createDataFrame(made, TURN).repartition(7)).orderBy("conv_id").collect()
    assert len(got) == len({m[0] for m in made})
    for conv in {m[0] for m in made}:
        want = "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for c, _, r, x in made if c == conv)
        assert "".join(g["text"] for g in got if g["conv_id"] == conv) == want


def test_a_long_conversation_is_one_row(spark):
    made = [(1, t, "user", f"t{t}") for t in range(3000)]
    (row,) = chat.chat_format_full(spark.createDataFrame(made, TURN)).collect()
    assert row["text"] == "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(3000))


def test_pair_text(spark):
    df = spark.createDataFrame([("hi", "yo")], "q string, a string")
    text = chat.chat_format_pairs(df, "q", "a").first()["text"]
    assert text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert chat.choose_text(df, "a").columns == ["text"]


def pairs(spark, n=60):
    rng = random.Random(8)
    words = ["red", "blue", "green", "one", "two"]
    made = [(i, " ".join(rng.choices(words, k=6)), " ".join(rng.choices(words, k=4))) for i in range(n)]
    return spark.createDataFrame(made, "row_ord bigint, inputs string, targets string")


def test_causal_flow(spark):
    made = pairs(spark)
    result = flows.causal_flow(made, made, flows.CausalOptions(max_seq_length=16, vocab_size=100))
    words = {r["token"]: r["id"] for r in result["vocab"].collect()}
    assert (words["<|im_start|>"], words["<|im_end|>"]) == (5, 6)
    stream_length = 60 * (2 * 3 + 6 + 4 + 1 + 0)  # start, role, end for two messages, the words, one end token
    assert result["rows"].count() == stream_length // 16
    assert 1 < result["perplexity"].first()[0] < 30


def test_every_causal_option_counts(spark):
    made = pairs(spark)
    small = flows.CausalOptions(max_seq_length=16, vocab_size=100)
    base = flows.causal_flow(made, made, small)
    n = base["rows"].count()
    updates = -(-(-(-n // 2)) // 4)
    assert [r["step"] for r in base["train_log"].orderBy("step").collect()] == list(range(5, 5 * updates + 1, 5))

    def log(**changed):
        return [(r["step"], round(r["mean_loss"], 9)) for r in flows.training_log(base["rows"], base["model"], replace(small, **changed)).orderBy("step").collect()]

    plain = log()
    assert [s for s, _ in log(num_train_epochs=2)] == list(range(5, 2 * updates + 1, 5))
    assert [s for s, _ in log(logging_steps=7)] == list(range(7, 5 * updates + 1, 7))
    assert len(log(gradient_accumulation=1)) == 5 * -(-n // 2) // 5
    assert log(random_seed=1) != plain and log(per_device_train_batch_size=1) != plain
    renamed = made.withColumnsRenamed({"inputs": "q", "targets": "a"})
    other = flows.causal_flow(renamed, renamed, replace(small, input_column="q", output_column="a"))
    assert other["perplexity"].first()[0] == pytest.approx(base["perplexity"].first()[0])
    ready = chat.chat_format_pairs(made).select("row_ord", F.col("text").alias("chat"))
    other = flows.causal_flow(ready, ready, replace(small, text_field="chat"))
    assert other["perplexity"].first()[0] == pytest.approx(base["perplexity"].first()[0])
    third = flows.causal_flow(made, made, replace(small, order=3))
    assert isinstance(third["model"], ngram.TrigramModel) and third["perplexity"].first()[0] < base["perplexity"].first()[0]
    with pytest.raises(ValueError, match="order"):
        flows.causal_flow(made, made, replace(small, order=4))


def test_masked_flow_end_to_end(spark):
    made = [(i, t) for i, t in enumerate(r["inputs"] + " " + r["targets"] for r in pairs(spark, 200).collect())]
    corpus = spark.createDataFrame(made, "row_ord bigint, text string")
    options = flows.MaskedOptions(chunk_size=8, batch_size=4, num_train_epochs=2, vocab_size=50)
    result = flows.masked_flow(corpus, options)
    n = result["chunks"].count()
    assert n == 200 * 12 // 8
    assert result["eval_losses"].agg(F.sum("n_rows")).first()[0] == 30
    trained = result["train_losses"].groupBy("epoch").agg(F.sum("n_rows").alias("n"), F.count("*").alias("batches"), F.sum("n_pred").alias("p"))
    by_epoch = {r["epoch"]: r for r in trained.collect()}
    assert all((r["n"], r["batches"]) == (270, 68) for r in by_epoch.values()) and by_epoch[0]["p"] != by_epoch[1]["p"]
    assert 1 < result["perplexity"].first()[0] < 50

    lines = spark.createDataFrame([(0, "red blue"), (1, ""), (2, "one two green")], "row_ord bigint, text string")
    got = flows.inference_losses(lines, result["model"], result["vocab"], 2, 8, flows.LABEL_MODES)
    assert {(r["label_mode"], r["batch_id"]): r["n_pred"] for r in got.collect()} == {
        ("all", 0): 16, ("all", 1): 8, ("real", 0): 6, ("real", 1): 5,
    }
    with pytest.raises(ValueError):
        flows.inference_losses(lines, result["model"], result["vocab"], label_modes=("none",))


def chunk_frame(spark, shift):
    made = [(i, [5 + (i * j + shift) % 9 for j in range(10)]) for i in range(20)]
    return spark.createDataFrame(made, "chunk_id bigint, input_ids array<int>")


def vocab_frame(spark):
    return materialize(vocab.number_tokens(spark.createDataFrame([("a", 3), ("b", 2)], "token string, freq bigint")), "v")


FITS = [lambda rows: ngram.fit_causal(rows, 20, 0.5), lambda rows: ngram.fit_masked(rows, 20, 0.5), lambda rows: ngram.fit_trigram(rows, 20)]


def same_tables(model, other):
    for name, table in model.tables().items():
        assert sorted(map(str, table.collect())) == sorted(map(str, other.tables()[name].select(table.columns).collect()))


@pytest.mark.parametrize("fit", FITS)
def test_model_folder(spark, tmp_path, fit):
    path = str(tmp_path / "model")
    for shift in (0, 3):  # the second save takes the place of the first
        model = fit(chunk_frame(spark, shift))
        writers.save_model(model, vocab_frame(spark), path)
    loaded, words = writers.load_model(spark, path)
    assert type(loaded) is type(model) and (loaded.vocab_size, loaded.k) == (20, model.k)
    assert words.count() == 7
    same_tables(model, loaded)


def test_a_model_is_saved_to_where_it_was_loaded_from(spark, tmp_path):
    path = str(tmp_path / "model")
    model = ngram.fit_masked(chunk_frame(spark, 0), 20)
    writers.save_model(model, vocab_frame(spark), path)
    loaded, words = writers.load_model(spark, path)
    writers.save_model(loaded, words, path)
    same_tables(model, loaded)
    writers.drop_old_versions(spark, path)
    same_tables(model, writers.load_model(spark, path)[0])
    assert writers.saves(spark, path).count() == 2 and len(list((tmp_path / "model" / "versions").iterdir())) == 1


def test_a_save_that_fails_leaves_the_model_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    with pytest.raises(ValueError, match="no model"):
        writers.load_model(spark, path)
    model = ngram.fit_causal(chunk_frame(spark, 0), 20)
    writers.save_model(model, vocab_frame(spark), path)

    def fail(*_):
        raise OSError("the driver is lost before the last row")

    with monkeypatch.context() as patch:
        patch.setattr(writers, "_point", fail)
        with pytest.raises(OSError):
            writers.save_model(ngram.fit_causal(chunk_frame(spark, 3), 20), vocab_frame(spark), path)
    broken = vocab_frame(spark).withColumn("id", F.raise_error(F.lit("a task fails")))
    with pytest.raises(Exception, match="a task fails"):
        writers.save_model(ngram.fit_causal(chunk_frame(spark, 3), 20), broken, path)
    same_tables(model, writers.load_model(spark, path)[0])


def test_model_folder_per_epoch(spark, tmp_path):
    path = str(tmp_path / "model")
    models = [ngram.fit_causal(chunk_frame(spark, shift), 20) for shift in (0, 1, 2)]
    for epoch in (0, 1):
        writers.save_model(models[epoch], vocab_frame(spark), path, epoch)
    writers.save_model(models[2], vocab_frame(spark), path, 1)
    with pytest.raises(ValueError, match="epoch 7"):
        writers.load_model(spark, path, 7)
    for epoch, want in ((0, models[0]), (1, models[2]), (None, models[2])):
        loaded, _ = writers.load_model(spark, path, epoch)
        assert sorted(loaded.bigrams.select("h", "w", "n").collect()) == sorted(want.bigrams.select("h", "w", "n").collect())


def test_run_log_is_emptied_at_start(spark, tmp_path):
    path = str(tmp_path / "log")
    values = spark.createDataFrame([(0, "loss", 1.5)], "epoch int, name string, value double")
    writers.start_run(spark, path, "other", {"x": 1})
    for _ in range(2):
        writers.start_run(spark, path, "mine", {"seed": 42, "model": "m", "flag": True})
        writers.log_metrics(values, path, "mine")
        writers.log_metrics(values, path, "mine")
    got = writers.read_log(spark, path).collect()
    mine = [r for r in got if r["run_id"] == "mine"]
    assert sorted((r["kind"], r["name"], r["value"], r["text"]) for r in mine if r["kind"] == "argument") == [
        ("argument", "flag", None, "True"), ("argument", "model", None, "m"), ("argument", "seed", 42.0, "42"),
    ]
    assert sum(r["kind"] == "metric" for r in mine) == 2
    assert len(got) - len(mine) == 2
    writers.start_run(spark, path, "mine", {})
    assert [r["kind"] for r in writers.read_log(spark, path).collect() if r["run_id"] == "mine"] == ["start"]


def test_stream_gives_the_rows_of_the_batch_form(spark, tmp_path):
    words = materialize(vocab.build_vocab(spark.createDataFrame([("red blue one two",)], "text string"), 20), "v")
    made = spark.createDataFrame([("  red blue ",), ("no",), ("one three two",)], "text string")
    made.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    query = stream_rows.write_rows(stream_rows.encode_lines(stream, words, 6), str(tmp_path / "out"), str(tmp_path / "state"))
    assert query.awaitTermination(120)
    got = sorted(r["input_ids"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(r["input_ids"] for r in stream_rows.encode_lines(made, words, 6).collect())
    assert len(got) == 2


def test_scratch_folder_follows_the_session(spark):
    path = scratch.scratch_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert path.startswith(root) if root else "lexmill-" in path


def test_scratch_tables_can_be_dropped(spark):
    materialize(spark.range(3), "dropped")
    scratch.drop_scratch(spark)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(scratch.scratch_dir(spark))
