import random
from collections import Counter, deque

import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from lexmill.functions import lookup
from lexmill.functions.scratch import materialize
from lexmill.operators import vocab
from lexmill.operators.encode import PieceTree, encode, encode_fixed, encode_ids, encode_subword_ids, model_inputs, pad_to_longest

TEXTS = ["the cat sat. the dog sat!", "", "a cat, a dog; ünïcode 東京 2024", "zebra\tzebra\x0bthe", "😀 the"]


def tokens_of(text):
    return regex.findall(vocab.WORDS.replace("\\x0B", "\x0b"), text)


def vocab_of(texts, size, specials=vocab.SPECIALS):
    counts = Counter(t for text in texts for t in tokens_of(text))
    ranked = sorted(counts, key=lambda t: (-counts[t], t.encode()))[: size - len(specials)]
    return {t: i for i, t in enumerate([*specials, *ranked])}


@pytest.mark.parametrize("size", [6, 9, 12, 1000])
def test_vocab_matches_model(corpus, size):
    got = vocab.build_vocab(corpus(TEXTS), size).collect()
    assert {r["token"]: r["id"] for r in got} == vocab_of(TEXTS, size)


def test_vocab_limits(corpus):
    assert vocab.build_vocab(corpus(TEXTS), 100, min_freq=2).count() == len(vocab.SPECIALS) + len(
        [t for t, n in Counter(t for x in TEXTS for t in tokens_of(x)).items() if n >= 2]
    )
    with pytest.raises(ValueError):
        vocab.build_vocab(corpus(TEXTS), 5)


def test_vocab_without_ceiling(corpus):
    got = vocab.build_vocab(corpus(TEXTS), None).collect()
    assert {r["token"]: r["id"] for r in got} == vocab_of(TEXTS, 10**6)


@pytest.mark.parametrize("size", [1, 3, 10, 40, 10**6])
@pytest.mark.parametrize("step", [1, 4])
def test_frequent_pieces_of_any_length(spark, monkeypatch, size, step):
    """The same pieces as counting every substring, whatever lengths a round covers."""
    monkeypatch.setattr(vocab, "PIECE_STEP", step)
    rng = random.Random(2)
    stems = ["internation", "al", "ness", "ab", "é東", "x"]
    words = {"".join(rng.choices(stems, k=rng.randint(1, 4))): rng.randint(1, 50) for _ in range(60)} | {"y" * 101: 500}
    every = Counter()
    for w, n in words.items():
        if len(w) <= 100:
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    every[("##" if i else "") + w[i:j]] += n
    want = sorted(every.items(), key=lambda p: (-p[1], p[0].encode()))[:size]
    df = materialize(spark.createDataFrame(list(words.items()), "token string, freq bigint"), "w")
    kept = materialize(vocab.frequent_pieces(df, size), "p")
    got = vocab.number_tokens(kept, size).filter("freq > 0").orderBy("id").collect()
    assert [(r["token"], r["freq"]) for r in got] == want
    assert max(len(t) for t, _ in want) > 4 or size < 40


def test_zwnj_joins_only_with_its_pattern(spark):
    df = spark.createDataFrame([("می‌روم",)], "text string")
    sizes = df.select(
        F.size(vocab.split_tokens(F.col("text"))), F.size(vocab.split_tokens(F.col("text"), vocab.WORDS_ZWNJ))
    ).first()
    assert tuple(sizes) == (3, 1)


def test_encode_matches_model(corpus):
    words = materialize(vocab.build_vocab(corpus(TEXTS), 9), "v")
    ids = vocab_of(TEXTS, 9)
    got = {r["row_ord"]: r for r in encode(corpus(TEXTS), words).collect()}
    for i, text in enumerate(TEXTS):
        want = [2, *[ids.get(t, 1) for t in tokens_of(text)], 3]
        assert got[i]["input_ids"] == want
        assert got[i]["token_type_ids"] == [0] * len(want)
        assert got[i]["attention_mask"] == [1] * len(want)


def test_encode_moves_no_rows(corpus, spark):
    words = materialize(vocab.build_vocab(corpus(TEXTS), 9), "v")
    plan = encode(materialize(corpus(TEXTS), "c"), words)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("head_bytes", [0, 60, 140, 1 << 20])
def test_the_same_ids_from_head_and_tail(corpus, head_bytes):
    texts = [*TEXTS, "unseen words the cat unseen", "unseen"]
    words = materialize(vocab.build_vocab(corpus(TEXTS), None), "v")
    ids = vocab_of(TEXTS, 10**6)
    got = {r["row_ord"]: r["input_ids"] for r in encode_ids(corpus(texts), words, head_bytes=head_bytes).collect()}
    assert got == {i: [2, *[ids.get(t, 1) for t in tokens_of(text)], 3] for i, text in enumerate(texts)}


def test_equal_hashes_are_told_apart(monkeypatch):
    """All tokens share a few hashes; the entries are still found by the tokens themselves."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(lookup, "_hashes", lambda tokens: np.array([len(t) for t in tokens], np.uint64))
    tokens = ["a", "b", "cc", "dd", "ee", "fff"]
    rows = pa.table({"token": tokens, "ids": pa.array([[i] for i in range(6)], pa.list_(pa.int32())), "hash": lookup._hashes(tokens)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    head = lookup._Head(sink.getvalue().to_pybytes())
    assert head.find(pa.array(["ee", "b", "zz", "fff", "gggg", "a"])).tolist() == [4, 1, -1, 5, -1, 0]


def test_a_vocabulary_of_two_million_tokens(spark, corpus):
    """More tokens than are broadcast, and a plan that does not carry them."""
    n = 1 << 21
    tokens = spark.range(n).select(
        F.concat(F.lit("t"), "id").alias("token"), (F.col("id") + 5).cast("int").alias("id"), (F.lit(n) - F.col("id")).alias("freq")
    )
    table = lookup.token_table(materialize(tokens, "big"))
    assert table.tail is not None and 0 < table.tail.count() < n
    assert len(table.head.value) < 2 * lookup.HEAD_BYTES
    rows = corpus(["t0 t1 t2097151 other t1500000", "t7"])
    got = lookup.tokens_to_ids(rows, F.split("text", " "), ["row_ord"], table, 1).orderBy("row_ord").collect()
    assert [r["input_ids"] for r in got] == [[5, 6, 2097156, 1, 1500005], [12]]


@pytest.mark.parametrize("n", [0, 1, 6, 7, 8, 58])
def test_fixed_length(corpus, n):
    text = " ".join(["the"] * n)
    words = materialize(vocab.build_vocab(corpus(["the the the"]), 9), "v")
    row = encode_fixed(corpus([text]), words, 8).first()
    bare = [5] * n
    kept = [2, *bare[:6], 3]
    assert row["input_ids"] == kept + [0] * (8 - len(kept))
    assert row["attention_mask"] == [1] * len(kept) + [0] * (8 - len(kept))
    assert model_inputs(encode_fixed(corpus([text]), words, 8)).columns == ["input_ids", "attention_mask"]


def test_pad_to_longest(spark):
    rows = [(0, [1, 2, 3], [1, 1, 1]), (0, [4], [1]), (1, [5], [1])]
    df = spark.createDataFrame(rows, "batch_id bigint, input_ids array<int>, attention_mask array<int>")
    got = sorted((r[0], r[1], r[2]) for r in pad_to_longest(df).collect())
    assert got == [(0, [1, 2, 3], [1, 1, 1]), (0, [4, 0, 0], [1, 0, 0]), (1, [5], [1])]


def greedy(word, pieces):
    if len(word) > 100:
        return [1]
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in pieces:
                out.append(pieces[piece])
                at = end
                break
        else:
            return [1]
    return out


def test_subword_matches_greedy_model(corpus, spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(150)] + ["a" * 101, "a" * 100]
    texts = [" ".join(rng.choices(words, k=20)) for _ in range(30)]
    pieces = ["a", "b", "c", "##a", "##b", "##c", "##d", "ab", "abc", "##bc", "##cda", "d##", "##ddd", "cab"]
    table = {t: i for i, t in enumerate([*vocab.SPECIALS, *pieces])}
    df = materialize(spark.createDataFrame([(t, i, 0) for t, i in table.items()], "token string, id int, freq bigint"), "p")
    want = [[2, *[i for w in t.split() for i in greedy(w, table)], 3] for t in texts]
    # With every word looked up where it stands, with most of them joined back, and with all of them.
    for head_bytes in (1 << 20, 900, 0):
        got = encode_subword_ids(corpus(texts), df, head_bytes=head_bytes).orderBy("row_ord").collect()
        assert [r["input_ids"] for r in got] == want


def test_one_walk_equals_greedy_search():
    rng = random.Random(8)
    for _ in range(200):
        made = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        pieces = {("##" if rng.random() < 0.6 else "") + p: i for i, p in enumerate(sorted(made))}
        tree = PieceTree(pieces.items())
        for _ in range(40):
            word = "".join(rng.choice("abc") if rng.random() < 0.03 else rng.choice("ab") for _ in range(rng.randint(1, 14)))
            assert tree.cut(word) == greedy(word, pieces)


def test_pieces_of_all_executors_are_checked(corpus, spark, monkeypatch):
    monkeypatch.setattr("lexmill.operators.encode.HEAD_BYTES", 3)
    pieces = spark.createDataFrame([("a", 5, 0)], "token string, id int, freq bigint")
    with pytest.raises(ValueError, match="bytes of sub-word pieces"):
        encode_subword_ids(corpus(["a"]), pieces)


def test_subword_equals_wordpiece_library(corpus, spark):
    tokenizers = pytest.importorskip("tokenizers")
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé東") for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    pieces = {w[i : i + k] if i == 0 else "##" + w[i : i + k] for w in words[:60] for i in range(len(w)) for k in (1, 2, 3)}
    table = {t: i for i, t in enumerate([*vocab.SPECIALS, *sorted(pieces)])}
    model = tokenizers.models.WordPiece(table, unk_token="[UNK]", max_input_chars_per_word=100)
    want = [[2, *[t.id for t in model.tokenize(w)], 3] for w in words]
    df = materialize(spark.createDataFrame([(t, i, 0) for t, i in table.items()], "token string, id int, freq bigint"), "p")
    got = encode_subword_ids(corpus(words), df).orderBy("row_ord").collect()
    assert [r["input_ids"] for r in got] == want


def test_a_worker_lets_go_of_a_batch_before_it_reads_the_next(spark):
    words = materialize(spark.createDataFrame([(f"w{i}", i, 1) for i in range(50)], "token string, id int, freq bigint"), "vocab")
    run = lookup._mapper(lookup.token_table(words), 1, ["doc_id"])
    held = []

    def batches():
        for _ in range(3):
            held.append(pa.total_allocated_bytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(100)), pa.array([[f"w{i % 60}" for i in range(5_000)]] * 100, pa.list_(pa.string()))], names=["doc_id", "_tokens"]
            )

    deque(run(batches()), maxlen=0)
    assert held[2] - held[1] < 100_000 and held[1] - held[0] < 100_000


@pytest.mark.parametrize("small", [1, 1 << 40])
def test_tokens_are_found_the_same_with_either_table(corpus, spark, monkeypatch, small):
    monkeypatch.setattr(lookup, "_SMALL_HEAD", small)
    words = materialize(vocab.build_vocab(corpus(TEXTS), 12), "vocab")
    ids = {r["token"]: r["id"] for r in words.collect()}
    for r, text in zip(encode_ids(corpus(TEXTS), words).orderBy("row_ord").collect(), TEXTS):
        assert r["input_ids"] == [vocab.CLS, *[ids.get(t, vocab.UNK) for t in tokens_of(text)], vocab.SEP]


def test_special_tokens_start_no_python_workers(spark, capsys):
    counts = materialize(spark.sql("select 'a' as token, 3L as freq"), "counts")
    vocab.number_tokens(counts, 5).explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    assert [r["token"] for r in vocab.number_tokens(counts, 5, ()).collect()] == ["a"]
