"""The three user-level flows: masked, causal, and perplexity of a saved model.

Phase boundaries are written tables (vocabulary, chunks, masked batches), so each later phase reads
only the columns it needs and nothing upstream is computed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize, spread
from lexmill.operators import batching, masking, metrics, ngram, packing, splitting, vocab
from lexmill.operators.chat import chat_format_pairs, choose_text
from lexmill.operators.encode import encode_fixed, encode_ids, with_masks
from lexmill.operators.ordinal import sorted_ordinal


@dataclass(frozen=True)
class MaskedOptions:
    mlm_probability: float = 0.2
    batch_size: int = 32
    chunk_size: int = 128
    num_train_epochs: int = 3
    random_seed: int = 42
    print_per_batch_num: int = 100
    train_size: float = 0.9
    test_size: float = 0.1
    vocab_size: int | None = 30_000


@dataclass(frozen=True)
class CausalOptions:
    """``order`` is the number of tokens a prediction looks at, itself included: 2 (additive smoothing) or 3 (back-off)."""

    num_train_epochs: int = 5
    per_device_train_batch_size: int = 2
    gradient_accumulation: int = 4
    logging_steps: int = 5
    max_seq_length: int = 256
    input_column: str = "inputs"
    output_column: str = "targets"
    text_field: str = "text"
    vocab_size: int | None = 30_000
    order: int = 2
    random_seed: int = 42


def make_vocab(corpus: DataFrame, size: int | None, **options) -> DataFrame:
    return materialize(vocab.build_vocab(spread(corpus), size, **options), "vocab")


def vocab_width(words: DataFrame) -> int:
    return words.count()


def encoded_rows(docs: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """(row_ord, input_ids) of documents, numbered by a unique ``key``.

    Texts are encoded where they are read and written as ids once. Only the keys are sorted for the numbers; the ids move
    when they meet them.
    """
    tokens = materialize(encode_ids(docs.select(key, "text"), words), "tokens")
    return tokens.join(sorted_ordinal(tokens.select(key), [key]), key).select("row_ord", "input_ids")


def make_chunks(tokens: DataFrame, chunk_size: int) -> DataFrame:
    """Written (window_id, chunk_no, chunk_id, input_ids) of (row_ord, input_ids); the constant columns are added on use."""
    chunks = packing.chunk_tokens(tokens, chunk_size)
    return materialize(chunks.select("window_id", "chunk_no", "chunk_id", "input_ids"), "chunks")


def split_side(split: DataFrame, side: str) -> DataFrame:
    return split.filter(F.col("split") == side).drop("split")


def eval_batches(test: DataFrame, width: int, o: MaskedOptions) -> DataFrame:
    """Statically masked evaluation batches, written once."""
    batches = batching.batch_in_split_order(test.select("chunk_id", "input_ids"), o.batch_size, o.random_seed)
    masked = masking.mask_static(batches, width, probability=o.mlm_probability, seed=o.random_seed)
    return materialize(masked, "eval_batches")


def epoch_losses(train: DataFrame, model: ngram.MaskedModel, width: int, o: MaskedOptions) -> DataFrame:
    """Losses of the freshly masked, freshly shuffled training batches of every epoch.

    Masks are drawn in the scan of the chunks and only the chosen positions go on; batches are orders of chunk ids. No epoch of the
    token arrays is written or moved. Sums per chunk and epoch then meet the batch that the chunk lies in.
    """
    rows = masking.repeat_epochs(train.select("chunk_id", "input_ids"), o.num_train_epochs)
    masked = masking.mask_epochs(rows, width, probability=o.mlm_probability, seed=o.random_seed)
    scored = metrics.row_losses(ngram.score_masked(masked, model, ["epoch", "chunk_id"]), ["epoch", "chunk_id"])
    orders = masking.repeat_epochs(train.select("chunk_id"), o.num_train_epochs)
    batches = batching.batch_shuffled(orders, o.batch_size, o.random_seed)
    return metrics.losses_of_rows(scored, batches, ["epoch", "chunk_id"], ["epoch"])


def masked_losses(batches: DataFrame, model: ngram.MaskedModel, keys: list[str] | None = None) -> DataFrame:
    scored = ngram.score_masked(batches, model, [*(keys or []), "batch_id"])
    return metrics.batch_losses(scored, batches, keys)


def score_causal_rows(rows: DataFrame, model: ngram.CausalModel | ngram.TrigramModel, keys: list[str]) -> DataFrame:
    score = ngram.score_trigram if isinstance(model, ngram.TrigramModel) else ngram.score_causal
    return score(rows, model, keys)


def causal_losses(
    batches: DataFrame, model: ngram.CausalModel | ngram.TrigramModel, keys: list[str] | None = None
) -> DataFrame:
    return metrics.batch_losses(score_causal_rows(batches, model, [*(keys or []), "batch_id"]), batches, keys)


def masked_flow(corpus: DataFrame, o: MaskedOptions = MaskedOptions()) -> dict[str, DataFrame | ngram.MaskedModel]:
    """Corpus (row_ord, text) to vocabulary, model, losses and perplexity."""
    words = make_vocab(corpus, o.vocab_size)
    width = vocab_width(words)
    chunks = make_chunks(encode_ids(corpus, words), o.chunk_size)
    split = splitting.split_exact(chunks, o.train_size, o.test_size, o.random_seed)
    model = ngram.fit_masked(split_side(split, "train"), width)
    train = epoch_losses(split_side(split, "train"), model, width, o)
    evaluated = masked_losses(eval_batches(split_side(split, "test"), width, o), model)
    return {
        "vocab": words,
        "chunks": with_masks(chunks),
        "model": model,
        "train_losses": train,
        "eval_losses": evaluated,
        "perplexity": metrics.perplexity_gather(evaluated, o.batch_size),
    }


def chat_texts(pairs: DataFrame, o: CausalOptions, keep: list[str]) -> DataFrame:
    """Pairs to ``keep`` and the chosen text field as ``text``: the formatted conversation, or a column that is there already."""
    formatted = pairs if o.text_field in pairs.columns else chat_format_pairs(pairs, o.input_column, o.output_column)
    return choose_text(formatted, o.text_field, keep)


def make_chat_rows(texts: DataFrame, words: DataFrame, length: int) -> DataFrame:
    """Chat texts (row_ord, text) to packed rows of ``length`` tokens."""
    ids = encode_ids(texts, words, add_special=False, pattern=vocab.CHAT_WORDS)
    tokens = materialize(ids.withColumn("n_tokens", F.size("input_ids")), "chat_tokens")
    end_id = len(vocab.SPECIALS) + vocab.CHAT_SPECIALS.index("<|im_end|>")
    return packing.pack_causal(tokens, end_id, length)


def make_chat_vocab(texts: DataFrame, size: int | None) -> DataFrame:
    specials = vocab.SPECIALS + vocab.CHAT_SPECIALS
    return make_vocab(texts.select("text"), size, specials=specials, pattern=vocab.CHAT_WORDS)


def fit_order(rows: DataFrame, width: int, order: int) -> ngram.CausalModel | ngram.TrigramModel:
    if order not in (2, 3):
        raise ValueError(f"order is {order}; 2 and 3 can be fitted")
    return ngram.fit_causal(rows, width) if order == 2 else ngram.fit_trigram(rows, width)


def training_log(rows: DataFrame, model: ngram.CausalModel | ngram.TrigramModel, o: CausalOptions) -> DataFrame:
    """(step, mean_loss) of the shuffled training batches of all epochs. A row's loss is the same in every epoch and worked out once."""
    scored = metrics.row_losses(score_causal_rows(rows, model, ["chunk_id"]), ["chunk_id"])
    orders = masking.repeat_epochs(rows.select("chunk_id"), o.num_train_epochs)
    batches = batching.batch_shuffled(orders, o.per_device_train_batch_size, o.random_seed)
    losses = metrics.losses_of_rows(scored, batches, ["chunk_id"], ["epoch"])
    return metrics.update_log(materialize(losses, "causal_losses"), o.gradient_accumulation, o.logging_steps)


def causal_flow(train: DataFrame, evaluation: DataFrame, o: CausalOptions = CausalOptions()) -> dict:
    """Pairs with dense ``row_ord`` to vocabulary, packed rows, model, training log, evaluation losses and perplexity."""
    texts = chat_texts(train, o, ["row_ord"])
    words = make_chat_vocab(texts, o.vocab_size)
    rows = materialize(make_chat_rows(texts, words, o.max_seq_length), "packed")
    model = fit_order(rows, vocab_width(words), o.order)
    tested = make_chat_rows(chat_texts(evaluation, o, ["row_ord"]), words, o.max_seq_length).select("chunk_id", "input_ids")
    batches = batching.batch_sequential(tested, o.per_device_train_batch_size, "chunk_id")
    losses = causal_losses(materialize(batches, "packed_eval"), model)
    return {
        "vocab": words,
        "rows": rows,
        "model": model,
        "train_log": training_log(rows, model, o),
        "eval_losses": losses,
        "perplexity": metrics.perplexity_weighted(losses),
    }


LABEL_MODES = ("all", "real")


def inference_losses(
    lines: DataFrame,
    model: ngram.MaskedModel,
    words: DataFrame,
    batch_size: int = 16,
    length: int = 512,
    label_modes: tuple[str, ...] = ("all",),
) -> DataFrame:
    """(label_mode, batch_id, …) losses of a saved model over (row_ord, text) lines, numbered densely.

    Mode ``all`` counts padding as targets, ``real`` leaves it out. The positions are scored once.
    """
    if not set(label_modes) <= set(LABEL_MODES):
        raise ValueError(f"label modes are {LABEL_MODES}")
    rows = encode_fixed(lines, words, length).select("row_ord", "input_ids", "attention_mask")
    batches = materialize(batching.batch_sequential(rows, batch_size), "inference")
    scored = ngram.score_all_positions(batches, model, ["batch_id"])
    modes = F.explode(F.array(*[F.lit(m) for m in label_modes]))
    counted = (F.col("label_mode") == "all") | F.col("is_real")
    return metrics.batch_losses(
        scored.withColumn("label_mode", modes).filter(counted), batches.withColumn("label_mode", modes), ["label_mode"]
    )
