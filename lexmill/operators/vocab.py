"""Token vocabularies as tables ``(token, id, freq)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.scratch import materialize
from lexmill.operators.ordinal import sorted_ordinal

# Special tokens; their ids are their positions.
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
CHAT_SPECIALS = ("<|im_start|>", "<|im_end|>")
PAD, UNK, CLS, SEP, MASK = range(5)
# The mark of a piece that does not begin its word, and the longest word that is cut into pieces.
CONTINUES = "##"
MAX_WORD_CHARS = 100
#: Lengths of pieces that are counted in one round.
PIECE_STEP = 4

# A token is a run of letters and digits, or one other visible character. Blanks are
# spelled out because `\s` differs between regex engines.
WORDS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r ])"
WORDS_ZWNJ = r"([\p{L}\p{N}\x{200C}]+|[^\p{L}\p{N}\x{200C}\t\n\x0B\f\r ])"
CHAT_WORDS = r"(<\|im_start\|>|<\|im_end\|>|[\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r ])"


def split_tokens(text: Column, pattern: str = WORDS) -> Column:
    """Text to an array of tokens; a missing text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern))


def token_counts(corpus: DataFrame, text: str = "text", pattern: str = WORDS) -> DataFrame:
    """(token, freq). Tokens are counted before the shuffle, so a frequent token costs one row per task."""
    tokens = corpus.select(F.explode(split_tokens(F.col(text), pattern)).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def cut_frequency(counts: DataFrame, size: int) -> int:
    """The lowest frequency that can be among the ``size`` most frequent rows; 0 if all rows are.

    Found from a table of how many rows have each frequency, so nothing is sorted but frequencies.
    """
    tally = counts.groupBy("freq").agg(F.count(F.lit(1)).alias("n"))
    from_top = F.sum("n").over(W.orderBy(F.desc("freq")).rowsBetween(W.unboundedPreceding, 0))
    cut = tally.withColumn("_cum", from_top).filter(F.col("_cum") >= size).agg(F.max("freq").alias("cut")).first()["cut"]
    return cut or 0


def number_tokens(counts: DataFrame, size: int | None = None, specials: tuple[str, ...] = SPECIALS) -> DataFrame:
    """Ids for the ``size`` most frequent rows of a written (token, freq) table, or for all: specials first, then by
    frequency and token.

    Rows below the lowest frequency that can get in are left out before the sort, which is by ranges: no task
    holds the whole vocabulary, however large it is.
    """
    if size is not None:
        counts = counts.filter(F.col("freq") >= cut_frequency(counts, size))
    ranked = sorted_ordinal(counts.select("token", "freq", (-F.col("freq")).alias("_falling")), ["_falling", "token"], "rank")
    if size is not None:
        ranked = ranked.filter(F.col("rank") < size)
    ids = (F.col("rank") + len(specials)).cast("int")
    numbered = ranked.select("token", ids.alias("id"), "freq")
    if not specials:
        return numbered
    # As literals: a table made of Python rows would start workers of its own on every core.
    entries = [F.struct(F.lit(t).alias("token"), F.lit(i).alias("id"), F.lit(0).cast("bigint").alias("freq")) for i, t in enumerate(specials)]
    fixed = counts.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*entries)))
    return fixed.unionByName(numbered)


def build_vocab(
    corpus: DataFrame,
    max_size: int | None = 30_000,
    min_freq: int = 1,
    specials: tuple[str, ...] = SPECIALS,
    text: str = "text",
    pattern: str = WORDS,
) -> DataFrame:
    """Vocabulary of a corpus. ``max_size`` counts the specials; None keeps every token."""
    if max_size is not None and max_size <= len(specials):
        raise ValueError(f"max_size must be above {len(specials)}")
    counts = token_counts(corpus, text, pattern).filter(~F.col("token").isin(*specials))
    kept = materialize(counts.filter(F.col("freq") >= min_freq), "counts")
    return number_tokens(kept, None if max_size is None else max_size - len(specials), specials)


def _piece(start: Column, length: Column) -> Column:
    return F.concat(F.when(start > 1, CONTINUES).otherwise(""), F.substring(F.col("token"), start, length))


def frequent_pieces(words: DataFrame, size: int, max_word: int = MAX_WORD_CHARS) -> DataFrame:
    """(token, freq) of sub-word pieces of any length, the ``size`` most frequent ones among them, weighted by word frequency.

    Pieces are substrings of the distinct words (token, freq) of up to ``max_word`` characters; those that do not begin the word
    carry the ``##`` mark. A piece is at most as frequent as what it begins with, so only places where the longest
    piece counted so far is still among the ``size`` most frequent are looked at again for longer ones. Each round counts
    `PIECE_STEP` more lengths; the places left shrink quickly and the rounds end when there are none.
    """
    n = F.length("token")
    places = words.filter(n <= max_word).select("token", "freq", F.explode(F.sequence(F.lit(1), n)).alias("at"))
    found: DataFrame | None = None
    done = 0
    while True:
        longest = F.least(F.lit(done + PIECE_STEP), n - F.col("at") + 1)
        cuts = places.select("token", "freq", "at", F.explode(F.sequence(F.lit(done + 1), longest)).alias("length"))
        pieces = cuts.select(_piece(F.col("at"), F.col("length")).alias("piece"), "freq")
        counted = materialize(pieces.groupBy(F.col("piece").alias("token")).agg(F.sum("freq").alias("freq")), "pieces")
        found = counted if found is None else found.unionByName(counted)
        floor = cut_frequency(found, size)
        found = materialize(found.filter(F.col("freq") >= floor), "frequent_pieces")
        done += PIECE_STEP
        going = found.select(F.col("token").alias("_end"))
        longer = places.filter(n - F.col("at") + 1 > done).withColumn("_end", _piece(F.col("at"), F.lit(done)))
        places = materialize(longer.join(going, "_end", "left_semi").drop("_end"), "piece_places")
        if places.isEmpty():
            return found
