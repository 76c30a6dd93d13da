import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexmill.functions.columns import NA_TEXTS
from lexmill.sources import readers


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def texts(df):
    return [r["text"] for r in df.orderBy("row_ord").collect()]


def test_dispatch_errors(spark, tmp_path):
    csv = write(tmp_path / "a.CSV", "text\nhello there\n")
    assert texts(readers.read_corpus(spark, csv, "text")) == ["hello there"]
    with pytest.raises(ValueError, match="target_column"):
        readers.read_corpus(spark, csv)
    with pytest.raises(ValueError, match="no column"):
        readers.read_corpus(spark, csv, "absent")
    with pytest.raises(ValueError, match="only .csv and .txt"):
        readers.read_corpus(spark, write(tmp_path / "a.json", "{}"))
    with pytest.raises(ValueError, match="empty"):
        readers.read_corpus(spark, write(tmp_path / "empty.csv", ""), "text")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_corpus(spark, str(tmp_path / "missing.txt"))
    assert readers.read_corpus(spark, write(tmp_path / "empty.txt", "")).count() == 0


def test_csv_quoting_and_missing(spark, tmp_path):
    rows = ['"two\nlines here"', '"he said ""hello"""', "back\\slash text", "", '" leading space"', "plain text"]
    rows += [f'"{na}"' for na in NA_TEXTS] + ["NA", "None"]
    path = write(tmp_path / "q.csv", "n,text\n" + "".join(f"{i},{r}\n" for i, r in enumerate(rows)))
    kept = ["two\nlines here", 'he said "hello"', "back\\slash text", " leading space", "plain text"]
    got = readers.read_corpus(spark, path, "text")
    assert texts(got) == kept
    assert [r[0] for r in got.orderBy("row_ord").select("row_ord").collect()] == list(range(len(kept)))


def test_line_breaks_are_lf_cr_crlf_only(spark, tmp_path):
    path = write(tmp_path / "l.txt", "line one\nline two\rline three\r\n\n  \nline four\nline\x85five\nline\x0csix\n")
    want = ["line one", "line two", "line three", "line four", "line\x85five", "line\x0csix"]
    assert texts(readers.read_corpus(spark, path)) == want


def test_eval_lines_are_not_filtered(spark, tmp_path):
    path = write(tmp_path / "e.txt", "first\n\n  x \nlast\n")
    assert texts(readers.read_eval_lines(spark, path)) == ["first", "", "  x ", "last"]


def test_bad_utf8(spark, tmp_path):
    path = write(tmp_path / "bad.txt", b"good line\nbad \xff line\n")
    assert len(texts(readers.read_corpus(spark, path))) == 2
    with pytest.raises(Exception, match="not valid UTF-8"):
        texts(readers.read_corpus(spark, path, strict_utf8=True))


def test_file_order_over_many_splits(spark, tmp_path):
    want = []
    for i, n in enumerate((300, 40, 900, 5)):
        lines = [f"file {i} line {j} " + "x" * (j % 50) for j in range(n)]
        write(tmp_path / "d.txt" / f"part-{i}.txt", "\n".join(line if j % 3 else "no" for j, line in enumerate(lines)) + "\n")
        want += [line.strip() for j, line in enumerate(lines) if j % 3]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert texts(readers.read_corpus(spark, str(tmp_path / "d.txt"))) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def pairs_csv(n, missing):
    return "id,inputs,targets\n" + "".join(f"{i},q{i},{'' if i in missing else f'a{i}'}\n" for i in range(n))


def test_pair_head_comes_before_dropping(spark, tmp_path):
    path = write(tmp_path / "pairs.csv", pairs_csv(1005, {3, 500, 1002}))
    got = readers.read_pairs(spark, path, head=1000).orderBy("row_ord").collect()
    assert [r["row_ord"] for r in got] == [i for i in range(1000) if i not in {3, 500}]
    assert got[3]["inputs"] == "q4" and got[3]["targets"] == "a4"
    assert readers.read_pairs(spark, path, head=None).count() == 1002


def test_pair_head_opens_more_files_when_needed(spark, tmp_path):
    for i in range(5):
        write(tmp_path / "many.csv" / f"f{i}.csv", pairs_csv(10, set()).replace("q", f"f{i}q"))
    got = readers.read_pairs(spark, str(tmp_path / "many.csv"), head=25).orderBy("row_ord").collect()
    assert [r["inputs"] for r in got] == [f"f{i // 10}q{i % 10}" for i in range(25)]


def test_pair_splits(spark, tmp_path):
    train = write(tmp_path / "x_train.csv", pairs_csv(4, {1}))
    write(tmp_path / "x_test.csv", pairs_csv(2, set()))
    got = readers.read_pair_splits(spark, train)
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 3, "test": 2}
    same = readers.read_pair_splits(spark, write(tmp_path / "pairs_all.csv", pairs_csv(3, set())))
    assert same.filter(F.col("split") == "test").count() == 3
    assert readers.sibling_eval_path("/train/train.csv") == "/test/test.csv"
    named = readers.read_pairs(spark, train, source="id", target="targets")
    assert [r["inputs"] for r in named.orderBy("row_ord").collect()] == ["0", "2", "3"]


def test_vocab_file(spark, tmp_path):
    path = write(tmp_path / "vocab.txt", "[PAD]\n[UNK]\n[CLS]\n[SEP]\n[MASK]\nword\n##s\n")
    got = {r["token"]: r["id"] for r in readers.read_vocab(spark, path).collect()}
    assert got == {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "[MASK]": 4, "word": 5, "##s": 6}


def test_strict_csv_refuses_bad_bytes(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_bytes(b"text\nfine line here\nbad \xff byte here\n")
    assert readers.read_corpus(spark, str(path), "text").count() == 2
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(path), "text", strict_utf8=True)


def test_pairs_are_read_whole_by_default(spark, tmp_path):
    path = tmp_path / "pairs.csv"
    path.write_text("inputs,targets\n" + "".join(f"a{i},b{i}\n" for i in range(1500)))
    assert readers.read_pairs(spark, str(path)).count() == 1500


def csv_text(rng, n):
    """Rows whose quoted cells hold line breaks, doubled quotes and separators, some over many lines."""
    def cell():
        kind = rng.random()
        if kind < 0.2:
            return "plain text" + "x" * rng.randint(0, 9)
        body = "".join(rng.choice(["a", " ", ",", "\n", "\r\n", '""', "é", "\n\n"]) for _ in range(rng.randint(0, 400 if kind > 0.97 else 25)))
        return f'"cell {body}"'

    return "n,text,more\n" + "".join(f"{i},{cell()},{cell()}\n" + "\n" * (rng.random() < 0.1) for i in range(n))


def test_quoted_csv_in_many_splits(spark, tmp_path):
    """The same rows as from whole files, wherever the files are cut."""
    rng = random.Random(11)
    for name in ("a", "b"):
        write(tmp_path / "big.csv" / f"{name}.csv", csv_text(rng, 300))
    write(tmp_path / "big.csv" / "c.csv", "n,text,more\r\n1,\"one\ncell\",x\r\n2,second cell,y")
    path = str(tmp_path / "big.csv")
    want = [r["text"] for r in readers.read_corpus(spark, path, "text").orderBy("row_ord").collect()]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("150b", "997b", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            got = readers.read_corpus(spark, path, "text", multi_line=readers.SPLITS).orderBy("row_ord").collect()
            assert [r["row_ord"] for r in got] == list(range(len(want)))
            assert [r["text"] for r in got] == want
        pairs = readers.read_pairs(spark, path, "text", "more", multi_line=readers.SPLITS)
        same = readers.read_pairs(spark, path, "text", "more")
        assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, same.collect()))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
