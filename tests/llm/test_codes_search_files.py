"""Vector codes, ranked search and token files against plain versions, and on odd rows."""

import glob
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from lexmill.llm import queries, ranked_search, token_files, vector_codes

SF = "/root/testdata/sf0.001"
BPE = queries.BYTE_BPE


def same_as_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, SF).select(*names).collect()
    want = found.fetchall()
    assert len(want) > 100 and sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


# -- vector codes -----------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(id, code, error) per row and the codebooks, row by row in Python integers."""
    whole = [(i, label, [math.floor(4096 * x) for x in v]) for i, v, label in rows]
    step = len(whole[0][2]) // parts
    first = sorted((i, q) for i, _, q in whole if i is not None)[:entries]
    books = [[q[p * step : (p + 1) * step] for _, q in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [[[] for _ in book] for book in books]
        for _, _, q in whole:
            for p in range(parts):
                x = q[p * step : (p + 1) * step]
                held[p][nearest(p, x)[1]].append(x)
        books = [[[sum(c) // len(own) for c in zip(*own)] if own else e for own, e in zip(held[p], books[p])] for p in range(parts)]
    out = []
    for i, label, q in whole:
        best = [nearest(p, q[p * step : (p + 1) * step]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    text = ",".join(str(c) for book in books for e in book for c in e)
    of_label = Counter()
    for _, label, _, error in out:
        of_label[label] += error
    return sorted(((i, c, e, of_label[label], hashlib.sha256(text.encode()).hexdigest()) for i, label, c, e in out), key=repr)


def vectors(spark, rows):
    """Rows of (id, vector, label) with further columns whose names the operator uses inside."""
    schema = "vec_id long, embedding array<double>, label int, part int, uid long, q string, code string, of int, n int"
    return spark.createDataFrame([(*r, 3, 4, "q", "c", 5, 6) for r in rows], schema)


def coded(spark, rows):
    got = vector_codes.coded(vectors(spark, rows)).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got), key=repr)


def test_codes_are_those_of_sql(spark):
    same_as_duckdb(spark, "op11_hilbert_blocks")


def test_codes_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i * 3 % 101, [rng.gauss(0, 1) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(90)]
    same = [0.25] * 16
    usable = [*rows, *[(500 + i, same, 7) for i in range(60)], (7, rows[0][1], 1), (7, rows[0][1], 1), (None, rows[1][1], None), (None, same, 2)]
    odd = [
        (600, None, 1), (601, [], 1), (602, [None] + [0.0] * 15, 1), (603, [math.nan] * 16, 1), (604, [math.inf] + [0.0] * 15, 1),
        (605, [1.0] * 8, 1), (606, [1.0] * 17, 1),
    ]
    assert coded(spark, usable + odd) == plain_codes(usable)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_codes_of_few_rows(spark, n):
    rows = [(i, [float((i * j) % 3) for j in range(8)], None) for i in range(n)]
    assert coded(spark, rows) == (plain_codes(rows) if n else [])


def test_components_out_of_reach_lie_on_its_border(spark):
    bound = vector_codes.reach(8) / 4096
    rows = [(i, [1e30 if i == j else -1e300 if i == j + 1 else 0.5 for j in range(8)], 1) for i in range(8)]
    clipped = [(i, [min(max(x, -bound), bound) for x in v], label) for i, v, label in rows]
    assert coded(spark, rows) == plain_codes(clipped)


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    """All cells have a place of their own, and cells next to each other on the curve share a side."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = vector_codes.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(2)
    cut = 0
    for _ in range(60):
        entries = rng.integers(-50, 50, (16, 4))
        rows = rng.integers(-50, 50, 4) + rng.integers(0, 12, (40, 4))
        allowed = vector_codes.shortlists(rows.min(axis=0)[None], rows.max(axis=0)[None], entries)
        cut += int((~allowed).sum())
        index, distance = vector_codes.nearest(rows, np.zeros(40, np.int64), allowed, entries)
        every = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert cut > 200


# -- ranked search ----------------------------------------------------------------------------

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [t.lower() for t in TERM.findall((text or "").encode())]


def plain_ranks(docs, items, top=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 75 + (75 * b.total() * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
                for t in plain_terms(text) if t in b
            )
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "t", 0.5) for i, t in docs], "doc_id long, text string, n long, norm long, terms string, score double")
    q = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id long, text string, rank int, item int")
    index, n = ranked_search.build(d)
    got = ranked_search.search(index, n, q).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr)


def test_ranks_are_those_of_sql(spark):
    same_as_duckdb(spark, "op12_max_sketch_search")


def test_ranks_on_odd_rows(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Éa", "éa", "東京", "x1", "ABC"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(120)]
    docs = [*enumerate(texts), (1, texts[1]), (300, texts[1]), (301, texts[1].upper()), (None, texts[1]), (None, texts[2])]
    docs += [(400, None), (401, ""), (402, " \n.,;"), (403, "w1-w1_w1\x7fw2"), (404, "tail w3 " * 60_000)]
    items = [(1, texts[1]), (2, "w1 w1 W2, éa 東京"), (3, None), (4, "..."), (5, "nothing here"), (1, texts[5]), (None, texts[1]), (6, "w3")]
    want = plain_ranks(docs, items)
    assert len(want) > 40
    assert ranked(spark, docs, items) == want
    # The same with an item to a block and thresholds from almost no documents.
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 1)
    monkeypatch.setattr(ranked_search, "SEED_DOCUMENTS", 3)
    assert ranked(spark, docs, items) == want


def test_ranks_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == [] and ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None), (2, "...")], [(1, "a")]) == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = ("aB c-d " * 50 + "x" * 90 + " e" * 30).encode()
    want = ranked_search.term_counts(text)
    monkeypatch.setattr(ranked_search, "_TEXT_PIECE", 7)
    assert ranked_search.term_counts(text) == want == Counter(plain_terms(text.decode()))


def test_bounds_are_never_below_the_score():
    """Also when all terms share one coordinate."""
    rng = random.Random(6)
    weight_of = {f"t{i}".encode(): rng.randint(1, 9000) for i in range(40)}
    items = ranked_search.Items([" ".join(f"t{rng.randrange(40)}" for _ in range(12)).encode() for _ in range(20)], weight_of)
    for width in (1, 8, 64):
        counts = {f"t{i}".encode(): rng.randint(1, 30) for i in rng.sample(range(60), 25)}
        impacts = {t: ranked_search.impact(c, 77) for t, c in counts.items()}
        sketch = np.zeros(width, np.uint8)
        for t, f in impacts.items():
            at = zlib.crc32(t) % width
            sketch[at] = max(sketch[at], -(-f // ranked_search.STEP))
        bounds = items.bounds([sketch.tobytes()], np.array([width]))[:, 0]
        exact = [sum(w * impacts.get(t, 0) for t, w in terms.items()) for terms in items.terms]
        assert (bounds >= exact).all()


# -- token files ------------------------------------------------------------------------------

LONG = "word tail " * 30_000


def documents(spark, rows):
    schema = "doc_id long, text string, part int, first long, ids string, row long, text_hash long"
    return spark.createDataFrame([(i, t, 1, 2, "x", 3, 4) for i, t in rows], schema)


def plain_stream(rows):
    """(doc_id, start, length, crc) in the order of ids, for distinct ids."""
    library, out, start = Tokenizer.from_file(BPE), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


def test_files_hold_the_stream(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i * 7 - 40, rng.choice([None, "", "x", "ü ñ 東京 <|endoftext|> a", " " * rng.randint(0, 9) + "word " * rng.randint(0, 60)])) for i in range(150)]
    rows += [(None, "null id"), (5000, LONG)]
    folder = str(tmp_path / "ids")
    token_files.write(documents(spark, rows).repartition(5), folder, BPE)
    want = plain_stream(rows)
    got = token_files.digests(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in got] == [w[:4] for w in want]
    read = token_files.placed(spark, folder).orderBy("start").collect()
    assert [r["ids"] for r in read] == [w[4] for w in want]
    stream = [t for w in want for t in w[4]]
    for low, high in ((0, 1), (17, 900), (len(stream) - 5, len(stream) + 50), (0, len(stream)), (len(stream), len(stream) + 9)):
        part = token_files.between(spark, folder, low, high).orderBy("start").collect()
        assert [t for r in part for t in r["ids"]] == stream[low:high]
        assert all(r["n_tokens"] == len(r["ids"]) for r in part)


def test_files_of_repeated_ids(spark, tmp_path):
    rows = [(7, "same text")] * 400 + [(7, "other")] * 3 + [(1, "a"), (9, "b")]
    folder = str(tmp_path / "ids")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(merge, "false")  # these rows are so few that they would be put together
        token_files.write(documents(spark, rows), folder, BPE)
    finally:
        spark.conf.unset(merge)
    got = token_files.digests(spark, folder).orderBy("start").collect()
    want = plain_stream(rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((w[0], w[2], w[3]) for w in want)
    assert [r["doc_id"] for r in got] == [w[0] for w in want]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:])) and got[0]["start"] == 0
    # A crowded id does not stay in one range.
    assert token_files.read(spark, folder).where("doc_id = 7").select("part").distinct().count() > 1


def test_files_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write(documents(spark, []), folder, BPE)
    assert token_files.digests(spark, folder).count() == 0 and token_files.between(spark, folder, 0, 9).count() == 0


def scanned(df):
    """Rows that the scan of a plan without exchange has given, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_metadata_rules_out_what_is_not_there(spark, tmp_path):
    folder = str(tmp_path / "ids")
    docs = documents(spark, [(2 * i, f"text {i}") for i in range(40_000)])
    token_files.write(docs, folder, BPE)
    for path in glob.glob(f"{folder}/*.orc"):
        file = orc.ORCFile(path)
        assert file.row_index_stride == token_files.INDEX_ROWS and file.compression == "ZSTD"
    assert [r["doc_id"] for r in token_files.find(spark, folder, [4444]).collect()] == [4444]
    assert scanned(token_files.find(spark, folder, [4444])) <= 8192
    # Outside all ranges, and inside one but in no Bloom filter.
    assert scanned(token_files.find(spark, folder, [10**9])) == 0
    assert sum(scanned(token_files.find(spark, folder, [2 * i + 1])) for i in range(100, 110)) <= 8192
