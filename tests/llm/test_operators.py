"""Operators against brute force, and on odd rows."""

import base64
import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexmill.llm import decontaminate, graph_ann, html_text, minhash, pack, passages, quality, queries, token_count, toxicity, warc
from lexmill.llm.components import components
from lexmill.llm.pieces import IdMemo, Splitter

SF = "/root/testdata/sf0.001"
BPE = queries.BYTE_BPE
LONG = "word tail " * 40_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, node long, cuts string, score double, bands int"


def documents(spark, rows):
    """Rows of (id, text) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", None, 1, 2, "c", 0.5, 3) for i, t in rows], DOCS)


def odd(spark):
    same = " ".join(f"w{i}" for i in range(80))
    return documents(spark, [(1, None), (2, ""), (3, same), (4, same), (4, same), (None, same), (5, "x"), (6, " \n\t"), (7, LONG), (8, "é" * 30)])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_ids_are_those_of_the_library():
    rng = random.Random(3)
    parts = ["a", "b", "Zé", "é", " ", "  ", "\n", "\t", "'s", "'", "'ll", ",", ".", "<|endoftext|>", "<|", "1", "23", " ", "　", "!!", "日本", "\x1c", "\r\n", "“", " a", " \n", "_", "\u0085", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    ids, offsets = IdMemo(Splitter(BPE), limit=700).encode(pa.array(texts))
    want = Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)
    assert all(ids[offsets[i] : offsets[i + 1]].tolist() == w.ids for i, w in enumerate(want))


def test_packing_round_trip(spark, small):
    odd_rows = odd(spark).select("doc_id", "text")
    docs = small.select("doc_id", "text").where("doc_id > 10").unionByName(odd_rows)
    got = pack.pack(docs, BPE, group_pieces=60).toPandas()
    library = Tokenizer.from_file(BPE)
    want = []
    for r in docs.collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        start, end = 0, len(ids) % 2048 or 2048
        while start < len(ids):
            want.append((-1 if r["doc_id"] is None else r["doc_id"], start, end - start, zlib.crc32(ids[start:end].tobytes())))
            start, end = end, end + 2048
    have = got.assign(doc_id=got["doc_id"].fillna(-1).astype(int))
    assert sorted(zip(have.doc_id, have.start, have.length, have.ids_crc32)) == sorted(want)
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) * 1.05 + 3


def test_one_group_packs_tightly():
    lengths = np.random.default_rng(1).integers(1, 2048, 3000)
    bins, offsets, fills = pack.pack_lengths(lengths, 2048)
    assert (np.bincount(bins, lengths) == fills).all() and fills.max() <= 2048
    assert len(fills) <= -(-lengths.sum() // 2048) * 1.02


def test_token_counts(spark, small):
    docs = small.select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    library = Tokenizer.from_file(BPE)
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    for head in (500, 1 << 18):
        got = token_count.count_tokens(docs, BPE, head=head).collect()
        assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def thue_morse(n, a, b):
    """Words that collide under every polynomial hash modulo a power of two, from about 1,000 letters on."""
    x = [0]
    while len(x) < n:
        x += [1 - i for i in x]
    return "".join((a, b)[i] for i in x[:n])


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_long_words_are_told_apart(spark, n):
    rows = [(1, thue_morse(n, "e", "t")), (2, thue_morse(n, "t", "e"))]
    docs = documents(spark, rows).coalesce(1)
    library = Tokenizer.from_file(BPE)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    counted = token_count.count_tokens(docs, BPE).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in counted} == {i: len(ids) for i, ids in want.items()}
    pieces = pack.pack(docs, BPE).collect()
    first = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in pieces if r["piece"] == 0}
    ids = {i: np.array(x + [0], "<u4") for i, x in want.items()}
    assert first == {i: (k := len(x) % 2048 or 2048, zlib.crc32(x[:k].tobytes())) for i, x in ids.items()}
    assert all(r["kept"] for r in minhash.near_duplicates(docs).collect())


def test_archives(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    twin = pages.selectExpr("page_id + 1000", "url", "html")
    con = duckdb.connect()
    rows = pages.union(twin).union(twin.selectExpr("`(page_id + 1000)` + 1000", "url", "substring(html, 1, 900)")).toDF("page_id", "url", "html")
    con.register("pages", rows.toPandas())
    want = sorted(con.execute(warc.ORACLE).fetchall(), key=str)
    folder = warc.scratch_path(spark, "warc")
    manifest = warc.write_archives(rows, folder, archive_bytes=20_000, chunk_bytes=700)
    got = [tuple(r) for r in warc.whole_records(warc.read_chunks(manifest, folder, chunk_bytes=333)).collect()]
    assert sorted(got, key=str) == want
    chunks = warc.read_chunks(manifest, folder, chunk_bytes=333).where("page_id = 1003").orderBy("chunk_no").collect()
    whole = rows.where("page_id = 1003").first()["html"].encode()
    assert b"".join(bytes(c["chunk"]) for c in chunks) == whole
    assert [c["digest_so_far"] for c in chunks] == [hashlib.sha1(whole[: c["bytes_so_far"]]).hexdigest() for c in chunks]


def test_archives_of_odd_pages(spark):
    big = "é" * 100_000
    rows = [(1, None, None), (2, "http://a b\n/x", big), (3, "u", big), (None, "u", big), (None, "v", "x"), (3, "u", big), (7, "", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as n", "2 as digest", "3 as salt")
    folder = warc.scratch_path(spark, "warc")
    got = warc.whole_records(warc.read_chunks(warc.write_archives(pages, folder), folder)).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in got) == [
        (0, "response", 0, 1), (0, "revisit", 3, 200_000), (1, "response", 0, 0), (2, "revisit", 3, 200_000),
        (3, "response", 0, 200_000), (3, "response", 0, 200_000), (7, "response", 0, 1000),
    ]
    assert warc.whole_records(warc.read_chunks(warc.write_archives(pages.limit(0), folder), folder)).count() == 0


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two <b>b</b>\n three", "one\ntwo b three"),
        ("<nav>menu</nav><article><h1>T</h1><p><b>a,&nbsp; b<br><p>c</article><footer>f</footer>", "T\na, b\nc"),
        ("<article><p>x y z, w</p><div class='comments'><p>no, no, no, no</p></div><script>var t='</p>'</script><p>end</article>", "x y z, w\nend"),
        ("<div id=c><h1>T</h1><div><p>a, b, c &#x26; d</p><ul><li>one<li>two</ul></div></div><div class='site-menu'>m</div>", "T\na, b, c & d\none\ntwo"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<article><p>cut in a ta<b", "cut in a ta"),
        ("<!-- open <p>x", ""),
        ("<p>1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<div>" * 5000 + "deep", "deep"),
        ("<form><p>field, field</p></form><p>text", "text"),
    ],
)
def test_main_text(source, text):
    assert html_text.main_text(source) == text


def test_raw_elements_and_stray_ends():
    body = "<article><p>Real text of an article, with commas, and long enough to be kept as such.</p>"
    for raw in ("<script src='x' />var x=1;</script>", "<style/>p {}</style>", "<script>var x=1;</script>", "<svg width='1'/>"):
        assert html_text.main_text(body + raw + "<p>The second part of it, also long enough, as can be seen.</p></article>").count("\n") == 1
    started = time.perf_counter()
    for tail in ("<b>" * 100_000 + "</i>" * 100_000, "<b>" * 60_000 + "<hr>" * 60_000, "<div>" * 50_000 + "</p>" * 50_000):
        assert html_text.main_text(body + tail).startswith("Real text")
    assert time.perf_counter() - started < 20


def test_pages_query(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>a</p>", 2), (1, "u", "<p>a</p>", 2)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, html_text.extract(pages).collect()), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]


WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def classes(texts, k, percent=80):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in texts}


def near_copies():
    """A chain of ever further edits, a dense group, and texts that share one line."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows, step = {}, list(base)
    for i in range(12):
        rows[i] = " ".join(step)
        step = list(step)
        step[9 * i] = f"e{i}"
    for i in range(20, 50):
        own = [f"g{j}" for j in range(200)]
        own[rng.randrange(200)] = f"h{i}"
        rows[i] = " ".join(own)
    for i in range(60, 90):
        rows[i] = "one common line of ten words that many texts share " + " ".join(f"t{i}_{j}" for j in range(rng.randint(0, 30)))
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, k):
    texts = near_copies()
    got = minhash.near_duplicates(documents(spark, list(texts.items())), shingle=k).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == classes(texts, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_dense_group_meets_few(spark, monkeypatch):
    """Near copies just too far from a group do not meet all of it, and those that one member of it links are found."""
    rng, base = random.Random(7), [f"b{i}" for i in range(200)]

    def edited(places, word):
        return " ".join(word(i) if i in places else w for i, w in enumerate(base))

    texts = {0: " ".join(base)}
    for i in range(1, 201):
        texts[i] = edited(rng.sample(range(200), 2), lambda at, i=i: f"own{i}_{at}")
    for i in range(300, 340):
        texts[i] = edited(rng.sample(range(0, 196, 4), 6), lambda at: f"e{at}")
    for i in range(3):
        places = [4 * (7 * i + j) for j in range(6)]
        texts[400 + i] = edited(places[:4], lambda at: f"f{at}")
        texts[410 + i] = edited(places, lambda at: f"f{at}")
    texts[420] = edited([160, 164, 168, 172, 176, 180, 184], lambda at: f"g{at}")
    texts[421] = edited([160, 164, 168, 172, 176, 180, 188], lambda at: f"g{at}")
    made, write = [], minhash.materialize

    def recorded(df, tag):
        out = write(df, tag)
        if tag == "candidates":
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "materialize", recorded)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(documents(spark, list(texts.items())), shingle=4).collect()}
    assert got == classes(texts, 4)
    assert got[411][1] == 0 and got[421][1] == 420
    assert max(made) < 1000


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_pairs_by_departures(spark, percent):
    rng = random.Random(percent)
    rows, sets, hubs = [], {}, {}
    for hub in (0, 1000):
        hubs[hub] = set(range(hub * 100, hub * 100 + 100))
        for node in range(hub + 1, hub + 71):
            out = rng.sample(sorted(hubs[hub]), rng.randint(0, 30))
            sets[node] = hubs[hub] - set(out) | {-1 - hub * 100 - i for i in rng.sample(range(60), rng.randint(0, 20))}
            comp = hub if node % 3 == 0 else node
            rows.append((hub, node, node, comp, comp == hub, len(sets[node]), sorted(sets[node] ^ hubs[hub])))

    def linked(x, y):
        return 100 * len(x & y) >= percent * len(x | y)

    want = set()
    for hub, a, _, ca, ina, _, _ in rows:
        for other, b, _, cb, inb, _, _ in rows:
            if hub == other and a < b and ca != cb and not (ina and inb) and linked(sets[a], sets[b]):
                if not (linked(sets[a], hubs[hub]) and linked(sets[b], hubs[hub])):
                    want.add((a, b))
    df = spark.createDataFrame(rows, "hub long, node long, mark long, comp long, inside boolean, n long, away array<long>")
    got = {(r["a"], r["b"]) for r in minhash.pairs_by_departures(df, percent).collect()}
    assert (want or percent == 95) and want <= got


def test_near_duplicates_of_odd_rows(spark):
    got = minhash.near_duplicates(odd(spark), shingle=4).collect()
    assert len(got) == 10
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (None, None, True), (5, 5, True), (6, 6, True), (7, 7, True), (8, 8, True),
    }
    assert minhash.near_duplicates(odd(spark).limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, j) for j in range(101, 130)] + [(200, 200), (140, 129)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 140: 100}


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    x[300:420] = x[3]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000, None, 0), (2020, [0.0] * 12, 0), (2040, [float("nan")] * 12, 0), (2060, [1.0] * 5, 0), (None, x[0].tolist(), 0), (7, x[7].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    got = graph_ann.search(df, every=20, k=10, shard_nodes=300, query_block=20).toPandas()
    hit = total = 0
    for q in range(0, 900, 20):
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and q not in set(own.vec_id)
        exact = x.astype(float) @ x[q].astype(float)
        assert np.allclose(own.score, exact[own.vec_id], atol=1e-12)
        assert list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
        exact[q] = -np.inf
        want = np.lexsort((np.arange(900), -exact))[:10]
        hit, total = hit + len(set(want) & set(own.vec_id)), total + 10
    assert len(got) == 450 and hit / total >= 0.95
    few = graph_ann.search(df.where("vec_id < 4"), every=1, k=20).collect()
    assert len(few) == 12
    assert graph_ann.search(df.limit(0), every=20, k=3).count() == 0


@pytest.mark.parametrize("kind", ["unit", "lognormal 0.25", "lognormal 1", "clustered"])
def test_recall_does_not_depend_on_norms(spark, kind):
    """With the parameters of the query, against exact inner products."""
    rng = np.random.default_rng(3)
    x = np.array(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()["embedding"].tolist())
    if kind.startswith("lognormal"):
        x = x * rng.lognormal(0, float(kind.split()[1]), len(x))[:, None]
    elif kind == "clustered":
        x = rng.normal(size=(30, 64))[rng.integers(0, 30, 2000)] * rng.lognormal(0, 0.5, 2000)[:, None] + 0.3 * rng.normal(size=(2000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = graph_ann.search(df, every=20, k=20).toPandas().groupby("query_id").vec_id.agg(set)
    exact = x[::20] @ x.T
    exact[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    hits = [len(got[20 * q] & set(np.argsort(-row, kind="stable")[:20].tolist())) for q, row in enumerate(exact)]
    assert np.mean(hits) / 20 >= 0.95


def test_passages(spark, small):
    texts = texts_of(small)
    found = {}
    for r in passages.passages(small).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert all(ref < r["doc_id"] for ref in r["ref_doc_ids"])
    seen, missing = set(), 0
    for i in sorted(texts):
        w = texts[i].lower().split()
        windows = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        need = {j for k, x in enumerate(windows) if x in seen for j in range(k, k + 50)}
        missing += len(need - found.get(i, set()))
        seen.update(windows)
    assert missing == 0


def test_fuzzy_passages(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(90)]
    other = list(passage)
    for i in (20, 41, 62):
        other[i] = "changed"
    del other[75]
    rows = [(1, [word() for _ in range(70)] + passage + [word() for _ in range(30)]), (2, [word() for _ in range(200)])]
    rows += [(3, [word() for _ in range(40)] + other + [word() for _ in range(60)]), (4, passage[:45] + [word() for _ in range(100)])]
    docs = documents(spark, [(i, " ".join(w)) for i, w in rows])
    found = passages.passages(docs)
    got = {r["doc_id"]: (r["start_word"], r["end_word"], r["ref_doc_id"]) for r in found.collect()}
    assert got == {3: (40, 129, 1)}
    left = texts_of(passages.remove_passages(docs, found))
    assert left[3].split() == rows[2][1][:40] + rows[2][1][129:] and left[1] == " ".join(rows[0][1])
    assert passages.remove_passages(docs, found).columns == docs.columns


def test_passages_of_odd_rows(spark):
    found = passages.passages(odd(spark))
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in found.collect()} == {(4, 0, 80)}
    left = passages.remove_passages(odd(spark), found)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "3", "5", "6", "7", "8", "None"]
    assert passages.passages(odd(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block_windows", [50_000, 300])
def test_decontamination(spark, small, block_windows):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    extra = spark.createDataFrame([(9001, "Erst zwei"), (None, "x y"), (9002, None), (9003, "!?")], "item_id long, text string")
    benchmark = benchmark.select("item_id", "text").unionByName(extra)
    docs = small.select("doc_id", "text").unionByName(spark.createDataFrame([(9000, "a, ERST-zwei b"), (None, None)], "doc_id long, text string"))
    items = [(str(r["item_id"]), r["text"]) for r in benchmark.collect() if r["item_id"] is not None]
    found = {r["doc_id"]: r for r in decontaminate.find_windows(docs, benchmark, block_windows=block_windows).collect()}
    texts = texts_of(docs)
    some = [i for i in texts if i in (9000, None) or found[i]["spans"] or i % 9 == 0]
    for i in some:
        n, hit, names = decontaminate.brute_force(texts[i], items)
        r = found[i]
        assert (n, hit, names) == (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"])
        for s in r["spans"]:
            raw = texts[i].encode()[s["first_byte"] : s["end_byte"]].decode()
            assert decontaminate.normal(raw.encode()).split() == decontaminate.normal(texts[i].encode()).split()[s["start"] : s["end"]]
    clean = {r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark, block_windows=block_windows).collect()}
    assert clean == {i for i in found if not found[i]["spans"]}
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == len(texts)


@pytest.mark.parametrize("operator, label, least", [(toxicity.toxicity, "toxic", 0.85), (quality.quality, "quality", 0.99)])
def test_classifiers_on_held_out_rows(spark, operator, label, least):
    sf = "/root/testdata/sf0.01"
    got = operator(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    rank, y = got.score.rank(), got[label]
    held = got.held_out
    fold = (5, 0) if label == "toxic" else (4, 2)
    assert (held == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % fold[0] == fold[1])).all()
    rank, y = got.score[held].rank(), got[label][held]
    area = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert area >= least and got.score.between(0, 1).all()


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_odd_rows(spark, module, label):
    docs = odd(spark)
    for rows in ([], [(3, 1), (None, 0)], [(3, 1), (5, 0), (5, 1), (7, 0), (8, 1), (2, 0), (99, 1), (6, None)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        model = module.learn(module.labelled_sample(docs, labels, label, 5, 9))
        got = module.score(docs, model).toPandas()
        assert len(got) == 10 and got.score.between(0, 1).all()
    if label == "quality":
        assert quality.keep_good(docs, {"share": 1.0}).count() == 10
        assert quality.keep_good(docs, {"share": 0.0}).columns == docs.columns


def test_pair_tables_use_every_bin_of_a_feature():
    """A feature of few bins spreads over as many runs, and an interaction of two such features is found."""
    widths = [3, 5, 48, 2, 1]
    for f, w in enumerate(widths):
        bins = np.zeros((w, len(widths)), np.int64)
        bins[:, f] = np.arange(w)
        runs = quality.coarse_bins(bins, widths)[:, f]
        assert len(set(runs)) == min(w, quality.PAIR_BINS) and (np.diff(runs) >= 0).all()
    rng = np.random.default_rng(4)
    bins = np.stack([rng.integers(0, w, 6000) for w in widths], axis=1)
    y = ((bins[:, 0] >= 2) ^ (bins[:, 1] >= 3)).astype(float)
    bias, tables, pairs = quality.boost(bins, y, np.arange(6000) % 4 == 0, widths, pairs=1)
    ((i, j, table),) = pairs
    assert {i, j} == {0, 1}
    coarse = quality.coarse_bins(bins, widths)
    z = bias + sum(t[bins[:, f]] for f, t in enumerate(tables)) + table[coarse[:, i] * quality.PAIR_BINS + coarse[:, j]]
    assert ((z > 0) == (y > 0)).mean() > 0.95


def test_rank_merges_match_the_ranks_file():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        want = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    assert Splitter(BPE).ranked._mergeable_ranks == want
