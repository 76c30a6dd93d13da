"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Each text is put together from named common table expressions; only the ones a query needs are used.
"""

from __future__ import annotations

import re

# What the queries are registered with, said here again: a wrong value in the engine must not be right in both places.
WORDS_SIZE, PIECES_SIZE, CHAT_SIZE = 8000, 4000, 4000
FIXED_LENGTH, CAUSAL_LENGTH, EVAL_BATCH, WORKERS = 512, 256, 16, 4
B, C, E, SEED, PROBABILITY = 32, 128, 3, 42, "0.2"
K = "0.1::DOUBLE"
# Special tokens, the patterns of words and line breaks, and the code points that are stripped.
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
CHAT_SPECIALS = ("<|im_start|>", "<|im_end|>")
WORDS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r ])"
CHAT_WORDS = r"(<\|im_start\|>|<\|im_end\|>|[\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r ])"
LINE_BREAK = r"\r\n|\r|\n"
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Eight hex digits below which lie a fifth, eight tenths and nine tenths of all such digits.
LIMIT_CHOSEN, LIMIT_MASK, LIMIT_RANDOM = "33333333", "cccccccd", "e6666666"


def _special_rows(names: tuple[str, ...]) -> str:
    return ", ".join(f"('{n}', {i}::INT, 0::BIGINT)" for i, n in enumerate(names))


def _vocab(counts: str, size: int, specials: tuple[str, ...]) -> str:
    n = len(specials)
    return f"""
        SELECT * FROM (VALUES {_special_rows(specials)}) s(token, id, freq)
        UNION ALL
        SELECT token, (row_number() OVER (ORDER BY freq DESC, token) + {n - 1})::INT, freq FROM (
            SELECT token, freq FROM ({counts}) ORDER BY freq DESC, token LIMIT {size - n})"""


def _unnested(source: str, key: str, pattern: str = WORDS) -> str:
    return f"""
        SELECT {key}, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM (
            SELECT {key}, regexp_extract_all(text, '{pattern}') AS t FROM {source})"""


def _bracketed(tokens: str, rows: str, key: str, vocab: str = "vocab") -> str:
    """Position 0 is [CLS], then the tokens, then [SEP]."""
    return f"""
        SELECT t.{key}, t.pos, coalesce(v.id, 1) AS id FROM {tokens} t LEFT JOIN {vocab} v USING (token)
        UNION ALL SELECT {key}, 0, 2 FROM {rows}
        UNION ALL SELECT r.{key}, coalesce(m.n, 0) + 1, 3 FROM {rows} r
            LEFT JOIN (SELECT {key}, max(pos) AS n FROM {tokens} GROUP BY {key}) m USING ({key})"""


def _masked(source: str, epoch: str, keep: str) -> str:
    """Position-level masking of rows with (chunk_id, p, id)."""
    block = f"md5('{SEED}:' || {epoch} || ':' || chunk_id || ':' || (p // 4))"
    return f"""
        SELECT {keep}, chunk_id, p, CASE WHEN chosen THEN id ELSE -100 END AS label,
            CASE WHEN NOT chosen OR substr(own, 1, 8) >= '{LIMIT_RANDOM}' THEN id
                 WHEN substr(own, 1, 8) < '{LIMIT_MASK}' THEN 4
                 ELSE (('0x' || substr(own, 9, 8))::BIGINT % (SELECT count(*) FROM vocab))::INT END AS id
        FROM (SELECT *, md5(digest || ':' || (p % 4)) AS own,
                  id >= 5 AND substr(digest, (p % 4)::INT * 8 + 1, 8) < '{LIMIT_CHOSEN}' AS chosen
              FROM (SELECT *, {block} AS digest FROM {source}))"""


def _batch(rank: str, size: int) -> str:
    return f"({rank}) // {size} AS batch_id, (({rank}) % {size})::INT AS pos_in_batch"


NEXT_TURN = """
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""

KEEP = f"text IS NOT NULL AND length(text) >= 5 AND trim(text, '{STRIP_CHARS}') <> ''"

MASKED_NLL = """
    SELECT p.*, -ln(0.4::DOUBLE * ((coalesce(a.n, 0) + {k}) / (coalesce(b.n, 0) + {k} * v))
        + 0.25::DOUBLE * ((coalesce(c1.n, 0) + {k}) / (coalesce(c2.n, 0) + {k} * v))
        + 0.25::DOUBLE * ((coalesce(d1.n, 0) + {k}) / (coalesce(d2.n, 0) + {k} * v))
        + 0.1::DOUBLE * ((coalesce(u.n, 0) + {k}) / (t.n + {k} * v))) AS nll
    FROM {positions} p
    CROSS JOIN (SELECT count(*) AS v FROM vocab) CROSS JOIN (SELECT sum(n) AS n FROM both_n) t
    LEFT JOIN both_n a USING (l, c, r)
    LEFT JOIN (SELECT l, r, sum(n) AS n FROM both_n GROUP BY l, r) b USING (l, r)
    LEFT JOIN (SELECT l, c, sum(n) AS n FROM both_n GROUP BY l, c) c1 USING (l, c)
    LEFT JOIN (SELECT l, sum(n) AS n FROM both_n GROUP BY l) c2 USING (l)
    LEFT JOIN (SELECT c, r, sum(n) AS n FROM both_n GROUP BY c, r) d1 USING (c, r)
    LEFT JOIN (SELECT r, sum(n) AS n FROM both_n GROUP BY r) d2 USING (r)
    LEFT JOIN (SELECT c, sum(n) AS n FROM both_n GROUP BY c) u USING (c)"""


def _neighbours(source: str, keys: str, row: str, where: str, centre: str = "label") -> str:
    return f"""
        SELECT {keys}, l, c, r FROM (
            SELECT {keys}, {centre} AS c, coalesce(lag(id) OVER w, -1) AS l, coalesce(lead(id) OVER w, -1) AS r, *
                EXCLUDE ({keys}) FROM {source} WINDOW w AS (PARTITION BY {row} ORDER BY p)) WHERE {where}"""


def _losses(scored: str, batches: str, keys: str = "batch_id") -> str:
    return f"""
        SELECT {keys}, n_rows, coalesce(n, 0) AS n_pred, s / n AS loss
        FROM (SELECT {keys}, count(*) AS n_rows FROM {batches} GROUP BY {keys})
        LEFT JOIN (SELECT {keys}, sum(nll) AS s, count(*) AS n FROM {scored} GROUP BY {keys}) USING ({keys})"""


CTES: dict[str, str] = {
    "docs": f"SELECT doc_id, text FROM documents WHERE {KEEP}",
    "corpus": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_ord, text FROM docs",
    "tokens": _unnested("corpus", "row_ord"),
    "counts": "SELECT token, count(*) AS freq FROM tokens GROUP BY token",
    "vocab": _vocab("SELECT * FROM counts", WORDS_SIZE, SPECIALS),
    "ids": _bracketed("tokens", "corpus", "row_ord"),
    "placed": """
        SELECT row_ord // 1000 AS window_id, id,
            row_number() OVER (PARTITION BY row_ord // 1000 ORDER BY row_ord, pos) - 1 AS gp FROM ids""",
    "chunk_pos": f"""
        SELECT window_id, gp // {C} AS chunk_no, window_id * 4294967296 + gp // {C} AS chunk_id, gp % {C} AS p, id
        FROM (SELECT *, count(*) OVER (PARTITION BY window_id, gp // {C}) AS n FROM placed) WHERE n = {C}""",
    "chunk_ids": "SELECT DISTINCT chunk_id FROM chunk_pos",
    "ranked": f"""
        SELECT chunk_id, row_number() OVER (ORDER BY md5('{SEED}:' || chunk_id), chunk_id) AS rk,
            count(*) OVER () AS n FROM chunk_ids""",
    "split": """
        SELECT chunk_id, CASE WHEN rk <= ceil(0.1::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM ranked
        WHERE rk <= ceil(0.1::DOUBLE * n) + floor(0.9::DOUBLE * n)""",
    "test_pos": "SELECT chunk_pos.* FROM chunk_pos JOIN split USING (chunk_id) WHERE split = 'test'",
    "train_pos": "SELECT chunk_pos.* FROM chunk_pos JOIN split USING (chunk_id) WHERE split = 'train'",
    "epochs": f"SELECT unnest(range({E}))::INT AS epoch",
    "eval_batches": f"""
        SELECT chunk_id, {_batch(f"row_number() OVER (ORDER BY md5('{SEED}:' || chunk_id), chunk_id) - 1", B)}
        FROM split WHERE split = 'test'""",
    "train_batches": f"""
        SELECT epoch, chunk_id, {_batch(
            f"row_number() OVER (PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || chunk_id), chunk_id) - 1",
            B)}
        FROM split CROSS JOIN epochs WHERE split = 'train'""",
    "eval_masked": _masked("(SELECT * FROM test_pos JOIN eval_batches USING (chunk_id))", "'-1'", "batch_id"),
    "train_masked": _masked(
        "(SELECT * FROM train_pos JOIN train_batches USING (chunk_id))", "epoch", "epoch, batch_id"
    ),
    # Models
    "bigrams": """
        SELECT h, w, count(*) AS n FROM (
            SELECT lag(id) OVER (PARTITION BY chunk_id ORDER BY p) AS h, id AS w FROM train_pos)
        WHERE h IS NOT NULL GROUP BY h, w""",
    "both_n": "SELECT l, c, r, count(*) AS n FROM ("
    + _neighbours("train_pos", "chunk_id", "chunk_id", "true", "id")
    + ") GROUP BY l, c, r",
    "causal_scored": f"""
        SELECT batch_id, -ln((coalesce(b.n, 0) + {K}) / (coalesce(c.n, 0) + {K} * (SELECT count(*) FROM vocab))) AS nll
        FROM (SELECT batch_id, lag(id) OVER (PARTITION BY chunk_id ORDER BY p) AS h, id AS w
              FROM test_pos JOIN eval_batches USING (chunk_id)) q
        LEFT JOIN bigrams b USING (h, w) LEFT JOIN (SELECT h, sum(n) AS n FROM bigrams GROUP BY h) c USING (h)
        WHERE q.h IS NOT NULL""",
    "causal_losses": _losses("causal_scored", "eval_batches"),
    "eval_positions": _neighbours("eval_masked", "batch_id", "chunk_id", "label <> -100"),
    "eval_scored": MASKED_NLL.format(k=K, positions="eval_positions"),
    "eval_losses": _losses("eval_scored", "eval_batches"),
    "train_positions": _neighbours("train_masked", "epoch, batch_id", "epoch, chunk_id", "label <> -100"),
    "train_scored": MASKED_NLL.format(k=K, positions="train_positions"),
    "train_losses": _losses("train_scored", "train_batches", "epoch, batch_id"),
    # Back-off model: occurrences at order 3, distinct left contexts below it.
    "tri_n": """
        SELECT coalesce(u, -1) AS u, h, w, count(*) AS n FROM (
            SELECT lag(id, 2) OVER s AS u, lag(id) OVER s AS h, id AS w FROM train_pos
            WINDOW s AS (PARTITION BY chunk_id ORDER BY p))
        WHERE h IS NOT NULL GROUP BY ALL""",
    "pair_n": "SELECT h, w, count(*) AS n FROM tri_n GROUP BY ALL",
    "token_n": "SELECT w, count(*) AS n FROM pair_n GROUP BY ALL",
    "wide_n": "SELECT u, h, sum(n)::BIGINT AS n, count(*) AS kinds FROM tri_n GROUP BY ALL",
    "narrow_n": "SELECT h, sum(n)::BIGINT AS n, count(*) AS kinds FROM pair_n GROUP BY ALL",
    "levels": """
        SELECT 3 AS level, n FROM tri_n UNION ALL SELECT 2, n FROM pair_n UNION ALL SELECT 1, n FROM token_n""",
    "discount_n": """
        SELECT level, CASE WHEN n1 = 0 THEN 0.5 ELSE n1 / (n1 + 2 * n2)::DOUBLE END AS d, n, kinds FROM (
            SELECT level, count(*) FILTER (n = 1) AS n1, count(*) FILTER (n = 2) AS n2, sum(n)::BIGINT AS n, count(*) AS kinds
            FROM levels GROUP BY level)""",
    "asked_tri": """
        SELECT batch_id, u, h, w FROM (
            SELECT batch_id, coalesce(lag(id, 2) OVER s, -1) AS u, lag(id) OVER s AS h, id AS w
            FROM test_pos JOIN eval_batches USING (chunk_id) WINDOW s AS (PARTITION BY chunk_id ORDER BY p))
        WHERE h IS NOT NULL""",
    "tri_p1": """
        SELECT q.*, greatest(coalesce(t.n, 0) - d.d, 0) / d.n + d.d * d.kinds / d.n / (SELECT count(*) FROM vocab) AS p1
        FROM asked_tri q LEFT JOIN token_n t USING (w) CROSS JOIN (SELECT * FROM discount_n WHERE level = 1) d""",
    "tri_p2": """
        SELECT q.*, CASE WHEN c.n IS NULL THEN p1 ELSE greatest(coalesce(t.n, 0) - d.d, 0) / c.n + d.d * c.kinds / c.n * p1 END AS p2
        FROM tri_p1 q LEFT JOIN pair_n t USING (h, w) LEFT JOIN narrow_n c USING (h)
        CROSS JOIN (SELECT * FROM discount_n WHERE level = 2) d""",
    "tri_scored": """
        SELECT q.batch_id, -ln(CASE WHEN c.n IS NULL THEN p2
            ELSE greatest(coalesce(t.n, 0) - d.d, 0) / c.n + d.d * c.kinds / c.n * p2 END) AS nll
        FROM tri_p2 q LEFT JOIN tri_n t USING (u, h, w) LEFT JOIN wide_n c USING (u, h)
        CROSS JOIN (SELECT * FROM discount_n WHERE level = 3) d""",
    "tri_losses": _losses("tri_scored", "eval_batches"),
    # Chat
    "turns": NEXT_TURN,
    "pairs": """
        SELECT conv_id, turn, text AS inputs, next_text AS targets FROM turns
        WHERE role = 'user' AND next_role = 'assistant'""",
    "chat": """
        SELECT conv_id, turn, '<|im_start|>user' || chr(10) || inputs || '<|im_end|>' || chr(10)
            || '<|im_start|>assistant' || chr(10) || targets || '<|im_end|>' || chr(10) AS text FROM pairs""",
    "chat_rows": "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_ord, text FROM chat",
    "chat_tokens": _unnested("chat_rows", "row_ord", CHAT_WORDS),
    "chat_vocab": _vocab(
        f"SELECT token, count(*) AS freq FROM chat_tokens WHERE token NOT IN {SPECIALS + CHAT_SPECIALS} GROUP BY token",
        CHAT_SIZE,
        SPECIALS + CHAT_SPECIALS,
    ),
    "chat_ids": """
        SELECT row_ord, pos, coalesce(id, 1) AS id FROM chat_tokens LEFT JOIN chat_vocab USING (token)
        UNION ALL SELECT row_ord, 1000000000, 6 FROM chat_rows""",
    "packed": f"""
        SELECT gp // {CAUSAL_LENGTH} AS chunk_id, gp % {CAUSAL_LENGTH} AS p, id
        FROM (SELECT *, count(*) OVER (PARTITION BY gp // {CAUSAL_LENGTH}) AS n FROM (
            SELECT id, row_number() OVER (ORDER BY row_ord, pos) - 1 AS gp FROM chat_ids))
        WHERE n = {CAUSAL_LENGTH}""",
    # Evaluation passages
    "items": "SELECT row_number() OVER (ORDER BY item_id) - 1 AS row_ord, text FROM benchmark",
    "item_tokens": _unnested("items", "row_ord"),
    "item_fixed": f"""
        SELECT g.row_ord, g.row_ord // {EVAL_BATCH} AS batch_id, p,
            CASE WHEN p = 0 THEN 2 WHEN p = least(n, {FIXED_LENGTH - 2}) + 1 THEN 3
                 WHEN p > least(n, {FIXED_LENGTH - 2}) THEN 0 ELSE coalesce(v.id, 1) END AS id,
            p <= least(n, {FIXED_LENGTH - 2}) + 1 AS is_real
        FROM (SELECT row_ord, coalesce(n, 0) AS n, unnest(range({FIXED_LENGTH})) AS p FROM items
              LEFT JOIN (SELECT row_ord, max(pos) AS n FROM item_tokens GROUP BY row_ord) USING (row_ord)) g
        LEFT JOIN item_tokens t ON t.row_ord = g.row_ord AND t.pos = g.p LEFT JOIN vocab v USING (token)""",
    "item_positions": "SELECT label_mode, batch_id, l, c, r FROM ("
    + _neighbours("item_fixed", "row_ord", "row_ord", "true", "id").replace(
        "SELECT row_ord, l, c, r FROM", "SELECT batch_id, is_real, l, c, r FROM"
    )
    + ") CROSS JOIN (VALUES ('all'), ('real')) m(label_mode) WHERE label_mode = 'all' OR is_real",
    "item_scored": MASKED_NLL.format(k=K, positions="item_positions"),
    "item_batches": f"""
        SELECT label_mode, row_ord // {EVAL_BATCH} AS batch_id FROM items
        CROSS JOIN (VALUES ('all'), ('real')) m(label_mode)""",
    "item_losses": _losses("item_scored", "item_batches", "label_mode, batch_id"),
}

TURN_CTES = {
    "turn_rows": "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_ord, text FROM conversations",
    "turn_tokens": _unnested("turn_rows", "row_ord"),
    "turn_ids": _bracketed("turn_tokens", "turn_rows", "row_ord"),
}

# Models fitted on every chunk, not on the train side only.
FITTED_ON_ALL = {"train_pos": "SELECT * FROM chunk_pos"}


def _with(body: str, recursive: str = "", **replace: str) -> str:
    """Prefix ``body`` with the expressions it uses, in dependency order."""
    ctes = {**CTES, **replace}
    chosen: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in chosen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(ctes[name])
                if name not in chosen:
                    chosen.append(name)

    visit(body + recursive)
    heads = [f"{name} AS MATERIALIZED ({ctes[name]})" for name in chosen]
    if recursive:
        heads.append(recursive)
    if not heads:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(heads) + "\n" + body


def _joined(column: str, order: str, alias: str) -> str:
    return f"list({column} ORDER BY {order})::VARCHAR AS {alias}"


# Longest-match-first walk over distinct words, one piece per step.
SUBWORD = f"""
    piece_vocab AS MATERIALIZED ({_vocab(
        "SELECT token, sum(freq)::BIGINT AS freq FROM ("
        " SELECT CASE WHEN a > 1 THEN '##' ELSE '' END || substr(token, a::INT, k::INT) AS token, freq FROM ("
        "  SELECT token, freq, a, unnest(range(1, length(token) - a + 2)) AS k FROM ("
        "   SELECT token, freq, unnest(range(1, length(token) + 1)) AS a FROM counts WHERE length(token) <= 100)))"
        " GROUP BY token",
        PIECES_SIZE, SPECIALS)}),
    walk AS (
        SELECT token, 1::BIGINT AS pos0, 0 AS step, NULL::INT AS id, false AS failed FROM counts WHERE length(token) <= 100
        UNION ALL
        SELECT token, coalesce(pos0 + k, 0), step + 1, pid, k IS NULL FROM (
            SELECT w.token, w.pos0, w.step, arg_max(v.id, g.k) FILTER (v.id IS NOT NULL) AS pid,
                max(g.k) FILTER (v.id IS NOT NULL) AS k
            FROM walk w JOIN (SELECT unnest(range(1, 101)) AS k) g ON w.pos0 + g.k - 1 <= length(w.token)
            LEFT JOIN piece_vocab v ON v.token =
                CASE WHEN w.pos0 > 1 THEN '##' ELSE '' END || substr(w.token, w.pos0::INT, g.k::INT)
            WHERE NOT w.failed AND w.pos0 <= length(w.token)
            GROUP BY w.token, w.pos0, w.step)),
    word_ids AS MATERIALIZED (
        SELECT c.token, CASE WHEN f.token IS NULL THEN [1] ELSE f.ids END AS ids FROM counts c LEFT JOIN (
            SELECT token, list(id ORDER BY step) AS ids FROM walk WHERE step > 0
            GROUP BY token HAVING NOT bool_or(failed)) f USING (token)),
    doc_tokens AS MATERIALIZED ({_unnested("docs", "doc_id")})"""


def oracle_sql() -> dict[str, str]:
    flag = ("input_ids", "token_type_ids", "attention_mask")
    lines = f"SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) - 1 AS line_no FROM (SELECT doc_id, string_split_regex(text, '{LINE_BREAK}') AS s FROM documents)"
    stripped = f"trim(line, '{STRIP_CHARS}')"
    q: dict[str, str] = {}
    q["csv_text_filter"] = _with("SELECT doc_id, text FROM docs")
    q["text_line_filter"] = (
        f"SELECT doc_id, (line_no)::INT AS line_no, {stripped} AS text FROM ({lines}) WHERE length({stripped}) >= 5"
    )
    q["filter_audit_lines"] = (
        f"SELECT count(*) AS n_before, count(*) FILTER (length({stripped}) >= 5) AS n_after FROM ({lines})"
    )
    q["filter_audit"] = f"SELECT count(*) AS n_before, count(*) FILTER ({KEEP}) AS n_after FROM documents"
    q["source_dispatch"] = _with(f"""
        SELECT row_ord, text, 'csv' AS source FROM corpus
        UNION ALL
        SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1, text, 'txt' FROM (
            SELECT doc_id, line_no, {stripped} AS text FROM ({lines})) WHERE length(text) >= 5""")
    q["quoted_csv_splits"] = _with("SELECT row_ord, text FROM corpus")
    q["eval_text_scan"] = f"""
        SELECT row_number() OVER (ORDER BY item_id, n) - 1 AS row_ord, text FROM (
            SELECT item_id, unnest(s) AS text, generate_subscripts(s, 1) AS n FROM (
                SELECT item_id, string_split_regex(text, '{LINE_BREAK}') AS s FROM benchmark))"""
    q["pair_scan"] = _with("""
        SELECT row_number() OVER (PARTITION BY conv_id % 2 ORDER BY conv_id, turn) - 1 AS row_ord, inputs, targets,
            CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM pairs""")
    q["pair_scan_head"] = _with("""
        SELECT * FROM (SELECT row_number() OVER (PARTITION BY conv_id % 2 ORDER BY conv_id, turn) - 1 AS row_ord, inputs, targets,
            CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM pairs) WHERE row_ord < 10""")
    q["pair_head_dropna"] = _with("""
        SELECT * FROM (SELECT conv_id, turn, text AS inputs, CASE WHEN next_role = 'assistant' THEN next_text END AS targets
            FROM turns WHERE role = 'user' ORDER BY conv_id, turn LIMIT 25)
        WHERE inputs IS NOT NULL AND targets IS NOT NULL""")
    q["vocab_source"] = _with("SELECT token, id FROM vocab")
    q["chat_format_pairs"] = _with("SELECT conv_id, turn, text FROM chat")
    q["chat_format_full"] = """
        SELECT conv_id, string_agg(
            '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text
        FROM conversations GROUP BY conv_id"""
    q["vocab_build"] = _with("SELECT token, id, freq FROM vocab")
    q["encode"] = _with(f"""
        SELECT row_ord, {_joined('id', 'pos', 'input_ids')}, {_joined('0', 'pos', 'token_type_ids')},
            {_joined('1', 'pos', 'attention_mask')} FROM ids GROUP BY row_ord""")
    q["subword_encode"] = _with(
        """
        SELECT doc_id, list(id ORDER BY pos, n)::VARCHAR AS input_ids FROM (
            SELECT doc_id, pos, unnest(ids) AS id, generate_subscripts(ids, 1) AS n FROM doc_tokens JOIN word_ids USING (token)
            UNION ALL SELECT doc_id, 0, 2, 0 FROM docs
            UNION ALL SELECT doc_id, 1000000000, 3, 0 FROM docs)
        GROUP BY doc_id""",
        SUBWORD,
    )
    limit = FIXED_LENGTH - 2
    q["encode_fixed"] = _with(f"""
        SELECT doc_id, list(CASE WHEN p = 0 THEN 2 WHEN p = used + 1 THEN 3 WHEN p > used THEN 0 ELSE coalesce(id, 1) END
                ORDER BY p)::VARCHAR AS input_ids,
            list(CASE WHEN p <= used + 1 THEN 1 ELSE 0 END ORDER BY p)::VARCHAR AS attention_mask
        FROM (SELECT doc_id, least(coalesce(n, 0), {limit}) AS used, unnest(range({FIXED_LENGTH})) AS p FROM documents
              LEFT JOIN (SELECT doc_id, max(pos) AS n FROM all_tokens GROUP BY doc_id) m USING (doc_id)) g
        LEFT JOIN (SELECT doc_id, pos AS p, token FROM all_tokens) t USING (doc_id, p) LEFT JOIN vocab USING (token)
        GROUP BY doc_id""",
        all_tokens=_unnested("documents", "doc_id"),
    )
    q["pad_to_longest"] = _with(
        f"""
        SELECT batch_id, row_ord, pos_in_batch, list(coalesce(id, 0) ORDER BY p)::VARCHAR AS input_ids,
            list((p < n)::INT ORDER BY p)::VARCHAR AS attention_mask
        FROM (SELECT *, unnest(range(longest)) AS p FROM (
            SELECT *, max(n) OVER (PARTITION BY batch_id) AS longest FROM (
                SELECT row_ord, {_batch('row_ord', EVAL_BATCH)}, count(*) AS n FROM turn_ids GROUP BY row_ord))) g
        LEFT JOIN (SELECT row_ord, pos AS p, id FROM turn_ids) t USING (row_ord, p)
        GROUP BY batch_id, row_ord, pos_in_batch""",
        **TURN_CTES,
    )
    q["map_windows"] = _with("""
        SELECT min(row_ord) AS first_row, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars
        FROM corpus GROUP BY row_ord // 1000""")
    q["collate_batches"] = _with(
        f"""
        SELECT batch_id, count(*) AS n_rows, max(n) AS width, sum(s)::BIGINT AS id_sum FROM (
            SELECT row_ord // {EVAL_BATCH} AS batch_id, count(*) AS n, sum(id) AS s FROM turn_ids GROUP BY row_ord)
        GROUP BY batch_id""",
        **TURN_CTES,
    )
    q["chunk_tokens"] = _with(f"""
        SELECT window_id, chunk_no, chunk_id, {_joined('id', 'p', 'input_ids')}, {_joined('0', 'p', 'token_type_ids')},
            {_joined('1', 'p', 'attention_mask')}, {_joined('id', 'p', 'labels')}
        FROM chunk_pos GROUP BY window_id, chunk_no, chunk_id""")
    q["pack_causal"] = _with(f"""
        SELECT chunk_id, {_joined('id', 'p', 'input_ids')}, {_joined('id', 'p', 'labels')} FROM packed GROUP BY chunk_id""")
    q["split_exact"] = _with("SELECT chunk_id, split FROM split")
    q["split_sizes"] = _with("""
        SELECT CASE WHEN rk <= ceil(0.1::DOUBLE * n) THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows FROM ranked
        WHERE rk <= ceil(0.1::DOUBLE * n) + floor(0.5::DOUBLE * n) GROUP BY 1""")
    q["train_eval_overlap"] = _with(f"""
        SELECT count(*) AS n_eval, count(*) FILTER (seen) AS n_overlap,
            round(count(*) FILTER (seen) / count(*)::DOUBLE, 6) AS ratio
        FROM (SELECT text IN (SELECT text FROM sided WHERE rk > ceil(0.1::DOUBLE * n)
                AND rk <= ceil(0.1::DOUBLE * n) + floor(0.9::DOUBLE * n)) AS seen
            FROM sided WHERE rk <= ceil(0.1::DOUBLE * n))""",
        sided=f"SELECT text, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS rk, count(*) OVER () AS n FROM docs",
    )
    q["mask_eval"] = _with(f"""
        SELECT chunk_id, {_joined('id', 'p', 'input_ids')}, {_joined('0', 'p', 'token_type_ids')},
            {_joined('1', 'p', 'attention_mask')}, {_joined('label', 'p', 'labels')} FROM eval_masked GROUP BY chunk_id""")
    q["mask_train_epochs"] = _with(f"""
        SELECT epoch, chunk_id, {_joined('id', 'p', 'input_ids')}, {_joined('label', 'p', 'labels')}
        FROM train_masked GROUP BY epoch, chunk_id""")
    q["batch_shuffle"] = _with("SELECT chunk_id, epoch, batch_id, pos_in_batch FROM train_batches")
    q["batch_sequential"] = _with("SELECT chunk_id, batch_id, pos_in_batch FROM eval_batches")
    q["batch_shards"] = _with(f"""
        SELECT epoch, batch_id, batch_id // 4 AS update_id, (batch_id % {WORKERS})::INT AS shard, chunk_id FROM train_batches""")
    q["step_budget"] = _with(f"""
        SELECT n AS n_rows, b AS batches_per_epoch, b * {E} AS training_steps, (b + 3) // 4 AS updates_per_epoch
        FROM (SELECT count(*) AS n, (count(*) + {B - 1}) // {B} AS b FROM split WHERE split = 'train')""")
    q["causal_fit"] = _with("""
        SELECT h, w, n FROM bigrams
        UNION ALL SELECT h, NULL, sum(n)::BIGINT FROM bigrams GROUP BY h""")
    blank = "NULL::INT AS u, NULL::INT AS h, NULL::INT AS w"
    q["trigram_fit"] = _with(f"""
        SELECT 'trigrams' AS table_name, u, h, w, n, NULL::BIGINT AS kinds, NULL::INT AS "order", NULL::DOUBLE AS discount FROM tri_n
        UNION ALL SELECT 'wide', u, h, NULL, n, kinds, NULL, NULL FROM wide_n
        UNION ALL SELECT 'pairs', NULL, h, w, n, NULL, NULL, NULL FROM pair_n
        UNION ALL SELECT 'narrow', NULL, h, NULL, n, kinds, NULL, NULL FROM narrow_n
        UNION ALL SELECT 'tokens', NULL, NULL, w, n, NULL, NULL, NULL FROM token_n
        UNION ALL SELECT 'discounts', {blank}, n, kinds, level, round(d, 9) FROM discount_n""")
    q["trigram_score"] = _with("SELECT batch_id, n_rows, n_pred, round(loss, 6) AS loss FROM tri_losses")
    q["masked_fit"] = _with("""
        SELECT l, c, r, sum(n)::BIGINT AS n, CASE grouping(l, c, r) WHEN 0 THEN 'both' WHEN 2 THEN 'sides' WHEN 1 THEN 'left'
            WHEN 4 THEN 'right' ELSE 'unigrams' END AS table_name
        FROM both_n GROUP BY GROUPING SETS ((l, c, r), (l, r), (l, c), (c, r), (c))""")
    q["causal_score"] = _with("SELECT batch_id, n_rows, n_pred, round(loss, 6) AS loss FROM causal_losses")
    q["masked_score"] = _with("SELECT batch_id, n_rows, n_pred, round(loss, 6) AS loss FROM eval_losses")
    q["all_position_score"] = _with(
        "SELECT label_mode, batch_id, n_rows, n_pred, round(loss, 6) AS loss FROM item_losses", **FITTED_ON_ALL
    )
    q["perplexity_weighted"] = _with(
        """SELECT label_mode, round(exp(sum(loss * n_rows) / sum(n_rows)), 4) AS perplexity
        FROM item_losses GROUP BY label_mode""",
        **FITTED_ON_ALL,
    )
    # The losses repeated row by row and cut, as the definition says.
    q["perplexity_gather"] = _with(f"""
        SELECT round(exp(avg(loss)), 4) AS perplexity FROM (
            SELECT loss, row_number() OVER (ORDER BY batch_id, i) AS rn, (SELECT sum(n_rows) FROM eval_losses) AS total
            FROM eval_losses CROSS JOIN (SELECT unnest(range({B})) AS i)) WHERE rn <= total""")
    q["perplexity_unweighted"] = _with(f"""
        SELECT s.step, m.batch_id, w.perplexity
        FROM (SELECT round(exp(avg(loss)), 4) AS perplexity FROM eval_losses) w
        CROSS JOIN (SELECT batch_id FROM eval_losses WHERE batch_id % 200 = 0) m
        CROSS JOIN (SELECT (epoch + 1) * ((SELECT count(*) FROM split WHERE split = 'train') + {B - 1}) // {B} AS step FROM epochs) s""")
    q["perplexity_unweighted"] = q["perplexity_unweighted"].replace(
        f"(epoch + 1) * ((SELECT count(*) FROM split WHERE split = 'train') + {B - 1}) // {B}",
        f"(epoch + 1) * (((SELECT count(*) FROM split WHERE split = 'train') + {B - 1}) // {B})",
    )
    q["running_loss"] = _with("""
        SELECT epoch, batch_id, round(m, 6) AS mean_loss FROM (
            SELECT epoch, batch_id, avg(loss) OVER (PARTITION BY epoch ORDER BY batch_id) AS m FROM train_losses)
        WHERE batch_id % 100 = 0""")
    q["epoch_loss"] = _with("SELECT epoch, round(avg(loss), 6) AS train_loss FROM train_losses GROUP BY epoch")
    q["phase_loss"] = _with("""
        SELECT phase, epoch, count(*) AS n_steps, round(avg(loss), 6) AS mean_loss FROM (
            SELECT 'train' AS phase, epoch, loss FROM train_losses
            UNION ALL SELECT 'val', epoch, loss FROM eval_losses CROSS JOIN epochs) GROUP BY phase, epoch""")
    q["chat_perplexity"] = _with(f"""
        SELECT round(exp(sum(loss * n_rows) / sum(n_rows)), 4) AS perplexity FROM (
            SELECT chunk_id // 2 AS batch_id, avg(nll) AS loss, count(DISTINCT chunk_id) AS n_rows FROM (
                SELECT chunk_id, -ln((b.n + {K}) / (c.n + {K} * (SELECT count(*) FROM chat_vocab))) AS nll
                FROM chat_pairs JOIN (SELECT h, w, count(*) AS n FROM chat_pairs GROUP BY h, w) b USING (h, w)
                JOIN (SELECT h, count(*) AS n FROM chat_pairs GROUP BY h) c USING (h)) GROUP BY 1)""",
        chat_pairs="""SELECT * FROM (SELECT chunk_id, lag(id) OVER (PARTITION BY chunk_id ORDER BY p) AS h, id AS w
            FROM packed) WHERE h IS NOT NULL""",
    )
    chat_pairs = """SELECT * FROM (SELECT chunk_id, lag(id) OVER (PARTITION BY chunk_id ORDER BY p) AS h, id AS w
        FROM packed) WHERE h IS NOT NULL"""
    q["chat_training_log"] = _with(f"""
        SELECT step::BIGINT AS step, round(avg(loss), 6) AS mean_loss FROM (
            SELECT ((u + up) // 4 + 1) * 4 AS step, loss, total FROM (
                SELECT epoch, batch_id // 3 AS u, sum(s) / sum(n) AS loss FROM log_rows GROUP BY epoch, batch_id)
            JOIN (SELECT epoch, coalesce(sum(updates) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS up,
                    sum(updates) OVER () AS total
                FROM (SELECT epoch, max(batch_id) // 3 + 1 AS updates FROM log_rows GROUP BY epoch)) USING (epoch))
        WHERE step <= total GROUP BY step""",
        log_rows="""
            SELECT epoch, (row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || chunk_id), chunk_id) - 1) // 2 AS batch_id, s, n
            FROM chat_rows_nll CROSS JOIN (VALUES (0), (1)) e(epoch)""",
        chat_rows_nll=f"""
            SELECT chunk_id, sum(-ln((b.n + {K}) / (c.n + {K} * (SELECT count(*) FROM chat_vocab)))) AS s, count(*) AS n
            FROM chat_pairs JOIN (SELECT h, w, count(*) AS n FROM chat_pairs GROUP BY h, w) b USING (h, w)
            JOIN (SELECT h, count(*) AS n FROM chat_pairs GROUP BY h) c USING (h) GROUP BY chunk_id""",
        chat_pairs=chat_pairs,
    )
    q["masked_flow"] = _with("""
        SELECT epoch, round(avg(loss), 6) AS train_loss, (SELECT count(*) FROM chunk_ids) AS n_chunks,
            (SELECT round(exp(sum(loss * n_rows) / sum(n_rows)), 4) FROM eval_losses) AS perplexity
        FROM train_losses GROUP BY epoch""")
    q["filter_audit_observed"] = f"""
        SELECT 'csv' AS kind, count(*) AS n_before, count(*) FILTER ({KEEP}) AS n_after, count(*) FILTER ({KEEP}) AS n_written FROM documents
        UNION ALL SELECT 'lines', count(*), count(*) FILTER (length({stripped}) >= 5), count(*) FILTER (length({stripped}) >= 5) FROM ({lines})"""
    test_pairs = """
        SELECT h, w, count(*) AS n FROM (
            SELECT lag(id) OVER (PARTITION BY chunk_id ORDER BY p) AS h, id AS w FROM test_pos)
        WHERE h IS NOT NULL GROUP BY h, w"""
    sized = "count(*) AS n_rows, sum(n)::BIGINT AS total"
    q["model_epochs"] = _with(f"""
        SELECT 0 AS epoch, 'bigrams' AS table_name, {sized} FROM test_bigrams
        UNION ALL SELECT 0, 'contexts', {sized} FROM (SELECT sum(n) AS n FROM test_bigrams GROUP BY h)
        UNION ALL SELECT 1, 'trigrams', {sized} FROM tri_n
        UNION ALL SELECT 1, 'wide', {sized} FROM wide_n
        UNION ALL SELECT 1, 'pairs', {sized} FROM pair_n
        UNION ALL SELECT 1, 'narrow', {sized} FROM narrow_n
        UNION ALL SELECT 1, 'tokens', {sized} FROM token_n
        UNION ALL SELECT 1, 'discounts', {sized} FROM discount_n""",
        test_bigrams=test_pairs,
    )
    sets = {"both": "l, c, r", "sides": "l, r", "left": "l, c", "right": "c, r", "unigrams": "c"}
    parts = [
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, sum(n)::BIGINT AS total FROM (SELECT sum(n) AS n FROM both_n GROUP BY {by})"
        for name, by in sets.items()
    ]
    parts.append("SELECT 'vocab', count(*), sum(freq)::BIGINT FROM vocab")
    q["model_roundtrip"] = _with(" UNION ALL ".join(parts), **FITTED_ON_ALL)
    q["metrics_log"] = _with(f"""
        SELECT 'run' AS run_id, 'metric' AS kind, 0 AS epoch, 'val_loss_' || batch_id AS name, round(loss, 6) AS value
        FROM eval_losses
        UNION ALL SELECT 'run', 'argument', NULL, 'batch_size', {B}
        UNION ALL SELECT 'run', 'argument', NULL, 'mlm_probability', {PROBABILITY}""")
    q["flagship"] = _with("""
        SELECT 'test' AS split, sum(n_rows)::BIGINT AS n_chunks, sum(n_pred)::BIGINT AS n_pred,
            round(exp(sum(loss * n_rows) / sum(n_rows)), 4) AS perplexity FROM causal_losses""")
    return q
