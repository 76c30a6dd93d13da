"""Count-based causal and masked models: tables fitted by grouping and read by joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.operators.masking import IGNORE

EDGE = -1
# A context with more than this share of all positions is handled without a shuffle.
HOT_SHARE = 8192


@dataclass(frozen=True)
class CausalModel:
    """``bigrams`` (h, w, n) and ``contexts`` (h, n): what follows a token."""

    bigrams: DataFrame
    contexts: DataFrame
    vocab_size: int
    k: float = 0.1

    def tables(self) -> dict[str, DataFrame]:
        return {"bigrams": self.bigrams, "contexts": self.contexts}


@dataclass(frozen=True)
class MaskedModel:
    """Counts of a centre token with both, one or none of its neighbours."""

    both: DataFrame  # (l, c, r, n)
    sides: DataFrame  # (l, r, n)
    left: DataFrame  # (l, c, n)
    right: DataFrame  # (c, r, n)
    unigrams: DataFrame  # (c, n)
    vocab_size: int
    k: float = 0.1
    weights: tuple[float, float, float, float] = field(default=(0.4, 0.25, 0.25, 0.1))

    def tables(self) -> dict[str, DataFrame]:
        return {
            "both": self.both,
            "sides": self.sides,
            "left": self.left,
            "right": self.right,
            "unigrams": self.unigrams,
        }


@dataclass(frozen=True)
class TrigramModel:
    """Back-off model of a token after the two before it, with absolute discounts.

    ``trigrams`` (u, h, w, n) holds how often a token followed its two predecessors (`EDGE` before a row). The lower orders do
    not count occurrences but left contexts: ``pairs`` (h, w, n) the distinct tokens seen before a pair, ``tokens`` (w, n) the distinct
    tokens before a token. ``wide`` (u, h, n, kinds) and ``narrow`` (h, n, kinds) are the totals of a context and how many
    different tokens followed in it. ``discounts`` (order, discount, n, kinds) has one row per order.
    """

    trigrams: DataFrame
    wide: DataFrame
    pairs: DataFrame
    narrow: DataFrame
    tokens: DataFrame
    discounts: DataFrame
    vocab_size: int
    k: float = 0.0  # no additive constant; kept so that all models are saved alike

    def tables(self) -> dict[str, DataFrame]:
        return {
            "trigrams": self.trigrams,
            "wide": self.wide,
            "pairs": self.pairs,
            "narrow": self.narrow,
            "tokens": self.tokens,
            "discounts": self.discounts,
        }


def _shifted_right(ids: Column) -> Column:
    return F.concat(F.array(F.lit(EDGE)), F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0))))


def _shifted_left(ids: Column) -> Column:
    return F.concat(F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))), F.array(F.lit(EDGE)))


def causal_positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, h, w): every token but the first of its row, with the token before it."""
    ids = F.col("input_ids")
    zipped = F.arrays_zip(_shifted_right(ids).alias("h"), ids.alias("w"))
    return rows.select(*keys, F.inline(zipped)).filter(F.col("h") != EDGE)


def trigram_positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, u, h, w): every token but the first of its row, with the two tokens before it."""
    ids = F.col("input_ids")
    before = _shifted_right(ids)
    zipped = F.arrays_zip(_shifted_right(before).alias("u"), before.alias("h"), ids.alias("w"))
    return rows.select(*keys, F.inline(zipped)).filter(F.col("h") != EDGE)


def masked_positions(rows: DataFrame, keys: list[str], flag: str | None = None) -> DataFrame:
    """(keys…, l, c, r): every labelled position; neighbours come from the corrupted row.

    ``flag`` names a list column whose entry is added as ``flag``.
    """
    ids = F.col("input_ids")
    parts = [_shifted_right(ids).alias("l"), F.col("labels").alias("c"), _shifted_left(ids).alias("r")]
    if flag:
        parts.append(F.col(flag).alias("flag"))
    return rows.select(*keys, F.inline(F.arrays_zip(*parts))).filter(F.col("c") != IGNORE)


def _count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _roll_up(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias("n"))


def fit_causal(rows: DataFrame, vocab_size: int, k: float = 0.1) -> CausalModel:
    """Bigram counts in one pass over the rows; the context totals roll the bigram table up."""
    bigrams = materialize(_count(causal_positions(rows, []), "h", "w"), "bigrams")
    return CausalModel(bigrams, _roll_up(bigrams, "h"), vocab_size, k)


def _contexts(counts: DataFrame, *keys: str) -> DataFrame:
    """Total of each context and the number of different tokens that followed in it."""
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))


def _discount(counts: DataFrame, order: int) -> DataFrame:
    """One row: the mass to take from every count, from how many counts are 1 and 2, and the order's totals.

    A half is taken where no count is 1. The discount is at most 1, so no count goes below 0.
    """
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    discount = F.when(once == 0, F.lit(0.5)).otherwise(once / (once + 2 * twice))
    return counts.agg(
        F.lit(order).alias("order"),
        discount.cast("double").alias("discount"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("kinds"),
    )


def fit_trigram(rows: DataFrame, vocab_size: int) -> TrigramModel:
    """One pass over the rows for the trigram table; every other table rolls up the one before it.

    The tables are written: scoring reads them several times, and their sizes tell the optimizer which are small.
    """
    trigrams = materialize(_count(trigram_positions(rows, []), "u", "h", "w"), "trigram_counts")
    pairs = materialize(_count(trigrams, "h", "w"), "left_contexts")
    tokens = materialize(_count(pairs, "w"), "token_contexts")
    discounts = _discount(trigrams, 3).unionByName(_discount(pairs, 2)).unionByName(_discount(tokens, 1))
    return TrigramModel(
        trigrams=trigrams,
        wide=materialize(_contexts(trigrams, "u", "h"), "wide_contexts"),
        pairs=pairs,
        narrow=materialize(_contexts(pairs, "h"), "narrow_contexts"),
        tokens=tokens,
        discounts=materialize(discounts, "discounts"),
        vocab_size=vocab_size,
    )


def fit_masked(rows: DataFrame, vocab_size: int, k: float = 0.1, **options) -> MaskedModel:
    """Trigram counts in one pass over the clean rows; all other tables roll the trigram table up.

    The pair tables are written too: scoring reads them several times.
    """
    clean = rows.withColumn("labels", F.col("input_ids"))
    both = materialize(_count(masked_positions(clean, []), "l", "c", "r"), "trigrams")
    left = materialize(_roll_up(both, "l", "c"), "left_pairs")
    return MaskedModel(
        both=both,
        sides=materialize(_roll_up(both, "l", "r"), "side_pairs"),
        left=left,
        right=materialize(_roll_up(both, "c", "r"), "right_pairs"),
        unigrams=_roll_up(left, "c"),
        vocab_size=vocab_size,
        k=k,
        **options,
    )


def _n(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _renamed(table: DataFrame, name: str) -> DataFrame:
    return table.withColumnRenamed("n", name)


def causal_nll(positions: DataFrame, model: CausalModel) -> DataFrame:
    """(h, w, seen, nll), one row per distinct pair that is to be scored."""
    distinct = positions.groupBy("h", "w").agg(F.count(F.lit(1)).alias("seen"))
    # One row per token; how it is joined is left to the size it turns out to have.
    contexts = _renamed(model.contexts, "n_h")
    p = (_n("n_hw") + model.k) / (_n("n_h") + model.k * model.vocab_size)
    return (
        distinct.join(_renamed(model.bigrams, "n_hw"), ["h", "w"], "left")
        .join(contexts, "h", "left")
        .select("h", "w", "seen", (-F.log(p)).alias("nll"))
    )


def _backed_off(n: str, total: str, kinds: str, discount: Column, lower: Column) -> Column:
    """What is left of a count after its discount, and the discounted mass spread by the lower order.

    A context that was never seen leaves everything to the lower order."""
    own = F.greatest(_n(n) - discount, F.lit(0.0)) / F.col(total)
    return F.when(F.col(total).isNull(), lower).otherwise(own + discount * F.col(kinds) / F.col(total) * lower)


def trigram_nll(positions: DataFrame, model: TrigramModel) -> DataFrame:
    """(u, h, w, seen, nll), one row per distinct trigram that is to be scored.

    Probabilities are worked out once per distinct token, then per distinct pair, then per distinct trigram, so a
    frequent token is one row of the lower orders. Each order is written: its size decides how the next one is joined.
    """
    distinct = materialize(positions.groupBy("u", "h", "w").agg(F.count(F.lit(1)).alias("seen")), "asked_trigrams")
    asked = materialize(distinct.select("h", "w").distinct(), "asked_pairs")
    rows = {r["order"]: r for r in model.discounts.collect()}
    d3, d2, d1 = (F.lit(rows[order]["discount"]) for order in (3, 2, 1))
    even, total, kinds = 1.0 / model.vocab_size, rows[1]["n"], rows[1]["kinds"]
    # Without any training pair every token is equally likely.
    single = F.greatest(_n("n_w") - d1, F.lit(0.0)) / total + d1 * kinds / total * even if total else F.lit(even)
    tokens = asked.select("w").distinct().join(_renamed(model.tokens, "n_w"), "w", "left").select("w", single.alias("p1"))
    narrow = model.narrow.withColumnsRenamed({"n": "n_h", "kinds": "k_h"})
    pairs = (
        asked.join(_renamed(model.pairs, "n_hw"), ["h", "w"], "left")
        .join(narrow, "h", "left")
        .join(materialize(tokens, "asked_tokens"), "w")
        .select("h", "w", _backed_off("n_hw", "n_h", "k_h", d2, F.col("p1")).alias("p2"))
    )
    wide = model.wide.withColumnsRenamed({"n": "n_uh", "kinds": "k_uh"})
    return (
        distinct.join(_renamed(model.trigrams, "n_uhw"), ["u", "h", "w"], "left")
        .join(wide, ["u", "h"], "left")
        .join(materialize(pairs, "pair_probabilities"), ["h", "w"])
        .select("u", "h", "w", "seen", (-F.log(_backed_off("n_uhw", "n_uh", "k_uh", d3, F.col("p2")))).alias("nll"))
    )


def masked_nll(positions: DataFrame, model: MaskedModel) -> DataFrame:
    """(l, c, r, seen, nll), one row per distinct context that is to be scored.

    The four estimates are smoothed and mixed, so the result is a probability for any weights that
    sum to one. Totals per left, right and centre token come from tables with one row per id.
    """
    distinct = positions.groupBy("l", "c", "r").agg(F.count(F.lit(1)).alias("seen"))
    # One row per token; how they are joined is left to the size they turn out to have.
    left_totals = _roll_up(model.left, "l").withColumnRenamed("n", "n_l")
    right_totals = _roll_up(model.right, "r").withColumnRenamed("n", "n_r")
    unigrams = _renamed(model.unigrams, "n_c")
    total = model.unigrams.agg(F.sum("n")).scalar()
    k, kv = model.k, model.k * model.vocab_size
    estimates = [
        (_n("n_lcr") + k) / (_n("n_lr") + kv),
        (_n("n_lc") + k) / (_n("n_l") + kv),
        (_n("n_cr") + k) / (_n("n_r") + kv),
        (_n("n_c") + k) / (F.coalesce(total, F.lit(0)) + kv),
    ]
    p = sum((F.lit(w) * e for w, e in zip(model.weights, estimates)), F.lit(0.0))
    return (
        distinct.join(_renamed(model.both, "n_lcr"), ["l", "c", "r"], "left")
        .join(_renamed(model.left, "n_lc"), ["l", "c"], "left")
        .join(_renamed(model.sides, "n_lr"), ["l", "r"], "left")
        .join(_renamed(model.right, "n_cr"), ["c", "r"], "left")
        .join(left_totals, "l", "left")
        .join(right_totals, "r", "left")
        .join(unigrams, "c", "left")
        .select("l", "c", "r", "seen", (-F.log(p)).alias("nll"))
    )


def attach_nll(positions: DataFrame, nll: DataFrame, context: list[str]) -> DataFrame:
    """Give every position the nll of its context, whatever the skew.

    Fewer than `HOT_SHARE` contexts can each hold more than 1/`HOT_SHARE` of all positions; those are
    broadcast, so the rows they match are never shuffled. Every other context is small, so joining
    the rest by key is balanced.
    """
    nll = materialize(nll, "nll")
    ids = [F.col(c) for c in context]
    least, most = (F.least(*ids), F.greatest(*ids)) if len(ids) > 1 else (ids[0], ids[0])
    found = nll.agg(F.sum("seen").alias("total"), F.min(least).alias("least"), F.max(most).alias("most")).first()
    keyed, on = _packed(context, found["least"], found["most"])
    is_hot = F.col("seen") * HOT_SHARE > F.lit(found["total"])
    values = keyed(nll).select(*on, "seen", "nll")
    hot = F.broadcast(values.filter(is_hot).drop("seen"))
    cold = values.filter(~is_hot).drop("seen")
    placed = keyed(positions)
    rest = placed.join(hot.drop("nll"), on, "left_anti").join(cold.hint("merge"), on)
    met = placed.join(hot, on).unionByName(rest)
    return met.select(*positions.columns, "nll")


def _packed(context: list[str], least: int | None, most: int | None):
    """How rows get their join key, and its columns: the ids of the context in one whole number, if they fit one, else the ids themselves.

    ``least`` and ``most`` are the bounds of all ids. One number is hashed, sorted and compared far faster than several.
    """
    bits = ((most or 0) - EDGE).bit_length()
    if (least is not None and least < EDGE) or bits * len(context) > 63:
        return (lambda rows: rows), context
    key = F.lit(0).cast("bigint")
    for c in context:
        key = F.shiftleft(key, bits).bitwiseOR((F.col(c) - EDGE).cast("bigint"))
    return (lambda rows: rows.withColumn("_key", key)), ["_key"]


def score_causal(rows: DataFrame, model: CausalModel, keys: list[str]) -> DataFrame:
    """(keys…, h, w, nll) for every predicted position; the first token of a row is not predicted."""
    positions = materialize(causal_positions(rows, keys), "positions")
    return attach_nll(positions, causal_nll(positions, model), ["h", "w"])


def score_trigram(rows: DataFrame, model: TrigramModel, keys: list[str]) -> DataFrame:
    """(keys…, u, h, w, nll) for every predicted position, the same ones as :func:`score_causal`."""
    positions = materialize(trigram_positions(rows, keys), "positions")
    return attach_nll(positions, trigram_nll(positions, model), ["u", "h", "w"])


def score_masked(rows: DataFrame, model: MaskedModel, keys: list[str]) -> DataFrame:
    """(keys…, l, c, r, nll) for every position whose label is set."""
    positions = materialize(masked_positions(rows, keys), "positions")
    return attach_nll(positions, masked_nll(positions, model), ["l", "c", "r"])


def score_all_positions(rows: DataFrame, model: MaskedModel, keys: list[str]) -> DataFrame:
    """(keys…, l, c, r, is_real, nll): every position is its own target, padding included.

    ``is_real`` is false on padding. Keep all rows for the mode that counts padding, filter on it for
    the mode that does not; either way the rows are scored once.
    """
    labelled = rows.withColumn("labels", F.col("input_ids"))
    positions = materialize(masked_positions(labelled, keys, flag="attention_mask"), "positions")
    scored = attach_nll(positions, masked_nll(positions, model), ["l", "c", "r"])
    return scored.withColumn("is_real", F.col("flag") == 1).drop("flag")
