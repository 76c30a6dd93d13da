"""Text to token ids. Encoding is a projection: rows are not moved or regrouped while the vocabulary fits a broadcast."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.lookup import HEAD_BYTES, token_table, tokens_to_ids
from lexmill.functions.scratch import materialize
from lexmill.functions.workers import reach_package
from lexmill.operators.vocab import CLS, CONTINUES, MAX_WORD_CHARS, PAD, SEP, UNK, WORDS, split_tokens, token_counts


def with_masks(df: DataFrame) -> DataFrame:
    """Add the type ids (one segment: all 0) and the attention mask (all 1) of unpadded rows."""
    n = F.size("input_ids")
    return df.withColumns(
        {"token_type_ids": F.array_repeat(F.lit(0), n), "attention_mask": F.array_repeat(F.lit(1), n)}
    )


def _bracket(ids: Column, add_special: bool) -> Column:
    return F.concat(F.array(F.lit(CLS)), ids, F.array(F.lit(SEP))) if add_special else ids


def encode_ids(
    corpus: DataFrame,
    vocab: DataFrame,
    add_special: bool = True,
    text: str = "text",
    pattern: str = WORDS,
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """Replace ``text`` by ``input_ids``; a token outside the vocabulary becomes the unknown id.

    ``vocab`` should be a written table (it is read more than once). Rows are not moved while it fits ``head_bytes``.
    """
    keep = [c for c in corpus.columns if c != text]
    table = token_table(vocab, "id", head_bytes)
    ids = tokens_to_ids(corpus, split_tokens(F.col(text), pattern), keep, table, UNK)
    return ids.select(*keep, _bracket(F.col("input_ids"), add_special).alias("input_ids"))


def encode(corpus: DataFrame, vocab: DataFrame, add_special: bool = True, **options) -> DataFrame:
    """Untruncated encoding with the three model inputs."""
    return with_masks(encode_ids(corpus, vocab, add_special, **options))


def _fixed_length(df: DataFrame, length: int) -> DataFrame:
    """Bare ids to rows of exactly ``length``: cut, bracket, pad on the right."""
    if length < 2:
        raise ValueError("length must leave room for the two end tokens")
    kept = F.concat(F.array(F.lit(CLS)), F.slice("input_ids", 1, length - 2), F.array(F.lit(SEP)))
    used = F.least(F.size("input_ids") + 2, F.lit(length))
    return df.withColumns(
        {
            "input_ids": F.concat(kept, F.array_repeat(F.lit(PAD), F.lit(length) - used)),
            "token_type_ids": F.array_repeat(F.lit(0), length),
            "attention_mask": F.concat(
                F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used)
            ),
        }
    )


def encode_fixed(corpus: DataFrame, vocab: DataFrame, length: int = 512, **options) -> DataFrame:
    """Truncate and pad to ``length``; the end tokens count inside the limit."""
    return _fixed_length(encode_ids(corpus, vocab, add_special=False, **options), length)


def pad_to_longest(batches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pad the rows of each batch to its longest row. One shuffle, by batch."""
    longest = F.max(F.size("input_ids")).over(W.partitionBy(*(keys or ["batch_id"])))
    missing = F.col("_longest") - F.size("input_ids")
    padded = {
        name: F.concat(F.col(name), F.array_repeat(F.lit(fill), missing))
        for name, fill in (("input_ids", PAD), ("token_type_ids", 0), ("attention_mask", 0))
        if name in batches.columns
    }
    return batches.withColumn("_longest", longest).select(
        *[padded[c].alias(c) if c in padded else F.col(c) for c in batches.columns]
    )


def model_inputs(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keep row keys and the two columns the scorer reads."""
    return df.select(*(keys or []), "input_ids", "attention_mask")


class PieceTree:
    """Longest-match-first pieces of a word in one walk over its characters.

    Pieces lie in two prefix trees, one for the beginning of a word and one for what continues it. A node that cannot go on
    knows which pieces its path breaks into by longest match, and the node of the second tree that the rest of the path leads
    to, so no character is looked at twice. Both are worked out once, level by level.
    """

    def __init__(self, pieces: Iterable[tuple[str, int]]):
        self.nexts: list[dict[str, int]] = [{}, {}]
        self.piece: list[int | None] = [None, None]
        for token, number in pieces:
            self._add(0, token, number)
            if token.startswith(CONTINUES) and len(token) > len(CONTINUES):
                self._add(1, token.removeprefix(CONTINUES), number)
        self._link()

    def _add(self, root: int, text: str, number: int) -> None:
        node = root
        for char in text:
            following = self.nexts[node].get(char)
            if following is None:
                following = self.nexts[node][char] = len(self.nexts)
                self.nexts.append({})
                self.piece.append(None)
            node = following
        self.piece[node] = number

    def _link(self) -> None:
        n = len(self.nexts)
        self.rest: list[int | None] = [None] * n
        self.broken: list[tuple[int, ...]] = [()] * n
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for char, child in self.nexts[node].items():
                    below.append(child)
                    if self.piece[child] is not None:
                        self.rest[child], self.broken[child] = 1, (self.piece[child],)
                        continue
                    at, taken = self.rest[node], self.broken[node]
                    while at is not None and char not in self.nexts[at]:
                        taken, at = taken + self.broken[at], self.rest[at]
                    if at is not None:
                        self.rest[child], self.broken[child] = self.nexts[at][char], taken
            level = below

    def cut(self, word: str) -> list[int]:
        """The pieces' ids, or the unknown id alone if any part of the word has no piece."""
        node, out = 0, []
        for char in word:
            while char not in self.nexts[node]:
                if self.rest[node] is None:
                    return [UNK]
                out += self.broken[node]
                node = self.rest[node]
            node = self.nexts[node][char]
        while node != 1:
            if self.rest[node] is None:
                return [UNK]
            out += self.broken[node]
            node = self.rest[node]
        return out


_trees: dict[str, PieceTree] = {}


def cut_words(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(token, ids, freq) of distinct words (token, freq), each cut once.

    Every executor holds all pieces, so their bytes are checked."""
    reach_package(words.sparkSession)
    size = pieces.agg(F.sum(F.octet_length("token") + 4)).first()[0] or 0
    if size > HEAD_BYTES:
        raise ValueError(f"{size} bytes of sub-word pieces are more than the {HEAD_BYTES} that every executor may hold")
    table = [(r["token"], r["id"]) for r in pieces.select("token", "id").collect()]
    name, packed = uuid.uuid4().hex, words.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _trees:
            _trees.clear()
            _trees[name] = PieceTree(packed.value)
        tree = _trees[name]
        for batch in batches:
            cuts = [tree.cut(w) if len(w) <= MAX_WORD_CHARS else [UNK] for w in batch.column("token").to_pylist()]
            ids = pa.array(cuts, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("token"), ids, batch.column("freq")], names=["token", "ids", "freq"])

    return words.select("token", "freq").mapInArrow(run, "token string, ids array<int>, freq bigint")


def encode_subword_ids(
    corpus: DataFrame,
    pieces: DataFrame,
    add_special: bool = True,
    text: str = "text",
    pattern: str = WORDS,
    counts: DataFrame | None = None,
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """Replace ``text`` by sub-word ``input_ids``.

    Every distinct word is cut once; the words and their pieces are then a table like a vocabulary: the frequent ones are looked up
    where they stand, the rest is joined back. ``counts`` is the written (token, freq) table of the words, if there is one.
    """
    if counts is None:
        counts = materialize(token_counts(corpus, text, pattern), "word_counts")
    table = token_table(materialize(cut_words(counts, pieces), "word_pieces"), "ids", head_bytes)
    keep = [c for c in corpus.columns if c != text]
    ids = tokens_to_ids(corpus, split_tokens(F.col(text), pattern), keep, table, UNK)
    return ids.select(*keep, _bracket(F.col("input_ids"), add_special).alias("input_ids"))


def encode_subword(corpus: DataFrame, pieces: DataFrame, add_special: bool = True, **options) -> DataFrame:
    return with_masks(encode_subword_ids(corpus, pieces, add_special, **options))
