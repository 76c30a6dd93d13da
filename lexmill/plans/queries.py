"""The registered queries: each runs one operator of the engine over the whole driver tables.

Array results are cast to text and doubles rounded, so that they compare with SQL.
"""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize, scratch_path, spread
from lexmill.operators import batching, chat, filters, masking, metrics, ngram, splitting, user, vocab
from lexmill.operators.encode import encode, encode_fixed, encode_ids, encode_subword, model_inputs, pad_to_longest, with_masks
from lexmill.operators.ordinal import dense_ordinal, sorted_ordinal
from lexmill.operators.packing import chunk_tokens
from lexmill.plans import flows
from lexmill.sources import readers, writers

WORDS_SIZE = 8_000
PIECES_SIZE = 4_000
CHAT_SIZE = 4_000
OPTIONS = flows.MaskedOptions(vocab_size=WORDS_SIZE)
CAUSAL_LENGTH = 256
CAUSAL = flows.CausalOptions(vocab_size=CHAT_SIZE, max_seq_length=CAUSAL_LENGTH)
FIXED_LENGTH = 512
EVAL_BATCH = 16
WORKERS = 4
#: Below the number of user turns at every scale, so that the limit cuts.
PAIR_HEAD = 25
PAIR_FILE_HEAD = 10
LINE_BREAK = r"\r\n|\r|\n"


# -- shared steps -----------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return filters.csv_text_filter(_table(spark, sf, "documents", "doc_id", "text"))


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return dense_ordinal(_docs(spark, sf), "doc_id").select("row_ord", "text")


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return flows.make_vocab(_docs(spark, sf), WORDS_SIZE)


def _encoded(spark: SparkSession, sf: str, words: DataFrame) -> DataFrame:
    return flows.encoded_rows(spread(_docs(spark, sf)), words, "doc_id")


def _chunks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    words = _words(spark, sf)
    return flows.make_chunks(_encoded(spark, sf, words), OPTIONS.chunk_size), words


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, int]:
    chunks, words = _chunks(spark, sf)
    split = splitting.split_exact(chunks, OPTIONS.train_size, OPTIONS.test_size, OPTIONS.random_seed)
    train, test = (flows.split_side(split, side) for side in ("train", "test"))
    return train, test, flows.vocab_width(words)


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "conversations", "conv_id", "turn", "role", "text")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sorted_ordinal(chat.turns_to_pairs(_turns(spark, sf)), ["conv_id", "turn"])


def _text(ids: str) -> Column:
    return F.col(ids).cast("string")


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: _text(c) for c in columns})


def _rounded(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


# -- filters and sources ----------------------------------------------------------------------


def csv_text_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.posexplode(F.split("text", LINE_BREAK)).alias("line_no", "text")
    )


def text_line_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.text_line_filter(_lines(spark, sf))


def filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_audit(_table(spark, sf, "documents", "text"))


def filter_audit_lines(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_audit(_lines(spark, sf), lines=True)


def filter_audit_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of both filters, taken while their results are written, and the rows that were written."""
    rows = []
    for kind, table in (("csv", _table(spark, sf, "documents", "text")), ("lines", _lines(spark, sf))):
        kept, seen = filters.observed_filter(table, lines=kind == "lines")
        written = materialize(kept, "filtered").count()
        rows.append((kind, seen.get["n_before"], seen.get["n_after"], written))
    return spark.createDataFrame(rows, "kind string, n_before bigint, n_after bigint, n_written bigint")


def _written_in_order(df: DataFrame, order: str, path: str, writer: str, **options) -> str:
    """Write rows so that file order is the given order."""
    ordered = df.repartitionByRange(order).sortWithinPartitions(order)
    getattr(ordered.drop(order).write.options(**options), writer)(path)
    return path


def source_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """The documents written as CSV and as text lines, and read back by extension."""
    docs = _table(spark, sf, "documents", "doc_id", "text")
    csv = _written_in_order(docs, "doc_id", scratch_path(spark, "docs") + ".csv", "csv", header=True, quoteAll=True, escape='"')
    txt = _written_in_order(docs, "doc_id", scratch_path(spark, "docs") + ".TXT", "text")
    from_csv = readers.read_corpus(spark, csv, "text").withColumn("source", F.lit("csv"))
    from_txt = readers.read_corpus(spark, txt).withColumn("source", F.lit("txt"))
    return from_csv.unionByName(from_txt)


def quoted_csv_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The documents written as CSV with their line breaks quoted, and read back by splits."""
    docs = _table(spark, sf, "documents", "doc_id", "text", "lang")
    csv = _written_in_order(docs, "doc_id", scratch_path(spark, "docs") + ".csv", "csv", header=True, quoteAll=True, escape='"')
    return readers.read_corpus(spark, csv, "text", multi_line=readers.SPLITS)


def eval_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation passages written as lines and scanned without any filter."""
    items = _table(spark, sf, "benchmark", "item_id", "text")
    return readers.read_eval_lines(
        spark, _written_in_order(items, "item_id", scratch_path(spark, "items") + ".txt", "text")
    )


def pair_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of even and odd conversations as train and test CSV, read as one table."""
    return readers.read_pair_splits(spark, f"{_written_pairs(spark, sf)}/train.csv")


def pair_scan_head(spark: SparkSession, sf: str) -> DataFrame:
    """The same, but only the first pairs of each file in file order."""
    return readers.read_pair_splits(spark, f"{_written_pairs(spark, sf)}/train.csv", head=PAIR_FILE_HEAD)


def _written_pairs(spark: SparkSession, sf: str) -> str:
    pairs = _pairs(spark, sf)
    root = scratch_path(spark, "pairs")
    for side, parity in (("train", 0), ("test", 1)):
        rows = pairs.filter(F.col("conv_id") % 2 == parity).select("row_ord", "inputs", "targets")
        _written_in_order(rows, "row_ord", f"{root}/{side}.csv", "csv", header=True, quoteAll=True, escape='"')
    return root


def pair_head_dropna(spark: SparkSession, sf: str) -> DataFrame:
    """The first user turns in order, and of those the ones an assistant turn answers."""
    answer = F.when(F.col("next_role") == "assistant", F.col("next_text"))
    asked = chat.next_turn(_turns(spark, sf)).filter(F.col("role") == "user")
    pairs = asked.select("conv_id", "turn", F.col("text").alias("inputs"), answer.alias("targets"))
    head = pairs.orderBy("conv_id", "turn").limit(PAIR_HEAD)
    return filters.drop_incomplete(head, ["inputs", "targets"])


def vocab_source(spark: SparkSession, sf: str) -> DataFrame:
    """The vocabulary written one token per line and read back with line numbers as ids."""
    lines = _words(spark, sf).select("id", "token")
    path = _written_in_order(lines, "id", scratch_path(spark, "tokens"), "text")
    return readers.read_vocab(spark, path).select("token", "id")


# -- chat -------------------------------------------------------------------------------------


def chat_format_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_format_pairs(chat.turns_to_pairs(_turns(spark, sf))).select("conv_id", "turn", "text")


def chat_format_full(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_format_full(_turns(spark, sf))


# -- tokens -----------------------------------------------------------------------------------


def vocab_build(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.build_vocab(spread(_docs(spark, sf)), WORDS_SIZE)


def encode_words(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_masks(_encoded(spark, sf, _words(spark, sf)))
    return _as_text(rows, "input_ids", "token_type_ids", "attention_mask")


def subword_encode(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    counts = materialize(vocab.token_counts(spread(docs)), "word_counts")
    size = PIECES_SIZE - len(vocab.SPECIALS)
    pieces = materialize(vocab.number_tokens(vocab.frequent_pieces(counts, size), size), "pieces")
    return _as_text(encode_subword(spread(docs), pieces, counts=counts).select("doc_id", "input_ids"), "input_ids")


def encode_fixed_length(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    rows = encode_fixed(spread(docs), _words(spark, sf), FIXED_LENGTH)
    return _as_text(model_inputs(rows, ["doc_id"]), "input_ids", "attention_mask")


def pad_to_longest_in_batch(spark: SparkSession, sf: str) -> DataFrame:
    turns = sorted_ordinal(_turns(spark, sf), ["conv_id", "turn"]).select("row_ord", "text")
    rows = batching.batch_sequential(encode(turns, _words(spark, sf)), EVAL_BATCH)
    return _as_text(pad_to_longest(rows).drop("token_type_ids"), "input_ids", "attention_mask")


# -- packing, splits, masks, batches ------------------------------------------------------------


def chunk_tokens_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = chunk_tokens(_encoded(spark, sf, _words(spark, sf)), OPTIONS.chunk_size)
    return _as_text(rows, "input_ids", "token_type_ids", "attention_mask", "labels")


def pack_causal(spark: SparkSession, sf: str) -> DataFrame:
    texts = flows.chat_texts(_pairs(spark, sf), CAUSAL, ["row_ord"])
    rows = flows.make_chat_rows(texts, flows.make_chat_vocab(texts, CHAT_SIZE), CAUSAL_LENGTH)
    return _as_text(rows.select("chunk_id", "input_ids", "labels"), "input_ids", "labels")


def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    chunks, _ = _chunks(spark, sf)
    return splitting.split_exact(chunks, OPTIONS.train_size, OPTIONS.test_size, OPTIONS.random_seed).select(
        "chunk_id", "split"
    )


def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes when the two sides do not use every row."""
    chunks, _ = _chunks(spark, sf)
    return splitting.split_sizes(splitting.split_exact(chunks, 0.5, 0.1, OPTIONS.random_seed))


def train_eval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    digests = materialize(_docs(spark, sf).select("doc_id", splitting.text_digest().alias("digest")), "digests")
    split = splitting.split_exact(digests, OPTIONS.train_size, OPTIONS.test_size, OPTIONS.random_seed, "doc_id")
    return _rounded(splitting.train_eval_overlap(split), "ratio")


def mask_eval(spark: SparkSession, sf: str) -> DataFrame:
    _, test, width = _split(spark, sf)
    rows = masking.mask_static(with_masks(test), width, probability=OPTIONS.mlm_probability, seed=OPTIONS.random_seed)
    columns = ["input_ids", "token_type_ids", "attention_mask", "labels"]
    return _as_text(rows.select("chunk_id", *columns), *columns)


def mask_train_epochs(spark: SparkSession, sf: str) -> DataFrame:
    train, _, width = _split(spark, sf)
    rows = masking.repeat_epochs(train.select("chunk_id", "input_ids"), OPTIONS.num_train_epochs)
    rows = masking.mask_epochs(rows, width, probability=OPTIONS.mlm_probability, seed=OPTIONS.random_seed)
    return _as_text(rows, "input_ids", "labels")


def _shuffled(train: DataFrame) -> DataFrame:
    rows = masking.repeat_epochs(train.select("chunk_id"), OPTIONS.num_train_epochs)
    return batching.batch_shuffled(rows, OPTIONS.batch_size, OPTIONS.random_seed)


def batch_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return _shuffled(_split(spark, sf)[0])


def batch_sequential(spark: SparkSession, sf: str) -> DataFrame:
    _, test, _ = _split(spark, sf)
    return batching.batch_in_split_order(test.select("chunk_id"), OPTIONS.batch_size, OPTIONS.random_seed)


def batch_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Shards of the training batches after a trip through one folder per worker."""
    path = scratch_path(spark, "shards")
    writers.write_shards(batching.shard_batches(_shuffled(_split(spark, sf)[0]), WORKERS), path)
    read = spark.read.parquet(path)
    return batching.with_update_id(read, 4).select("epoch", "batch_id", "update_id", "shard", "chunk_id")


def step_budget(spark: SparkSession, sf: str) -> DataFrame:
    return batching.step_budget(_split(spark, sf)[0], OPTIONS.batch_size, OPTIONS.num_train_epochs)


# -- models, losses, perplexity -----------------------------------------------------------------


def causal_fit(spark: SparkSession, sf: str) -> DataFrame:
    train, _, width = _split(spark, sf)
    model = ngram.fit_causal(train, width)
    return model.bigrams.unionByName(model.contexts.withColumn("w", F.lit(None).cast("int")))


def trigram_fit(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of the back-off model in one: counts, left contexts, context totals and discounts."""
    train, _, width = _split(spark, sf)
    tables = ngram.fit_trigram(train, width).tables()
    tables["discounts"] = _rounded(tables["discounts"], "discount", 9)
    named = [t.withColumn("table_name", F.lit(name)) for name, t in tables.items()]
    rows = named[0]
    for table in named[1:]:
        rows = rows.unionByName(table, allowMissingColumns=True)
    return rows


def masked_fit(spark: SparkSession, sf: str) -> DataFrame:
    train, _, width = _split(spark, sf)
    tables = ngram.fit_masked(train, width).tables()
    named = [t.withColumn("table_name", F.lit(name)) for name, t in tables.items()]
    rows = named[0]
    for table in named[1:]:
        rows = rows.unionByName(table, allowMissingColumns=True)
    return rows


def causal_score(spark: SparkSession, sf: str) -> DataFrame:
    train, test, width = _split(spark, sf)
    batches = batching.batch_in_split_order(test.select("chunk_id", "input_ids"), OPTIONS.batch_size)
    batches = materialize(batches, "causal_eval")
    return _rounded(flows.causal_losses(batches, ngram.fit_causal(train, width)), "loss")


def trigram_score(spark: SparkSession, sf: str) -> DataFrame:
    train, test, width = _split(spark, sf)
    batches = batching.batch_in_split_order(test.select("chunk_id", "input_ids"), OPTIONS.batch_size)
    batches = materialize(batches, "causal_eval")
    return _rounded(flows.causal_losses(batches, ngram.fit_trigram(train, width)), "loss")


def _eval_losses(train: DataFrame, test: DataFrame, width: int) -> DataFrame:
    return flows.masked_losses(flows.eval_batches(test, width, OPTIONS), ngram.fit_masked(train, width))


def masked_score(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_eval_losses(*_split(spark, sf)), "loss")


def _inference_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Losses of the benchmark passages under the masked model, with and without padding."""
    chunks, words = _chunks(spark, sf)
    model = ngram.fit_masked(chunks, flows.vocab_width(words))
    lines = dense_ordinal(_table(spark, sf, "benchmark", "item_id", "text"), "item_id")
    return flows.inference_losses(lines, model, words, EVAL_BATCH, FIXED_LENGTH, flows.LABEL_MODES)


def all_position_score(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_inference_losses(spark, sf), "loss")


def perplexity_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.perplexity_weighted(_inference_losses(spark, sf), ["label_mode"]), "perplexity", 4)


def perplexity_gather(spark: SparkSession, sf: str) -> DataFrame:
    losses = materialize(_eval_losses(*_split(spark, sf)), "losses")
    return _rounded(metrics.perplexity_gather(losses, OPTIONS.batch_size), "perplexity", 4)


def perplexity_unweighted(spark: SparkSession, sf: str) -> DataFrame:
    """The value logged at every 200th validation batch of each epoch, with the step it was logged at."""
    train, test, width = _split(spark, sf)
    losses = masking.repeat_epochs(_eval_losses(train, test, width), OPTIONS.num_train_epochs)
    per_epoch = batching.step_budget(train, OPTIONS.batch_size).select("batches_per_epoch")
    steps = masking.repeat_epochs(per_epoch, OPTIONS.num_train_epochs).select(
        "epoch", (F.col("batches_per_epoch") * (F.col("epoch") + 1)).alias("step")
    )
    return _rounded(metrics.validation_log(materialize(losses, "losses"), steps), "perplexity", 4)


def _train_losses(train: DataFrame, width: int) -> DataFrame:
    return materialize(flows.epoch_losses(train, ngram.fit_masked(train, width), width, OPTIONS), "losses")


def running_loss(spark: SparkSession, sf: str) -> DataFrame:
    train, _, width = _split(spark, sf)
    return _rounded(metrics.running_loss(_train_losses(train, width), OPTIONS.print_per_batch_num), "mean_loss")


def epoch_loss(spark: SparkSession, sf: str) -> DataFrame:
    train, _, width = _split(spark, sf)
    return _rounded(metrics.epoch_loss(_train_losses(train, width)), "train_loss")


def phase_loss(spark: SparkSession, sf: str) -> DataFrame:
    train, test, width = _split(spark, sf)
    trained = _train_losses(train, width).withColumn("phase", F.lit("train"))
    tested = masking.repeat_epochs(_eval_losses(train, test, width), OPTIONS.num_train_epochs)
    both = trained.unionByName(tested.withColumn("phase", F.lit("val")))
    return _rounded(metrics.phase_loss(both), "mean_loss")


def chat_perplexity(spark: SparkSession, sf: str) -> DataFrame:
    """The causal flow on conversation pairs, evaluated on its own training set as the default path does."""
    pairs = _pairs(spark, sf)
    return _rounded(flows.causal_flow(pairs, pairs, CAUSAL)["perplexity"], "perplexity", 4)


def chat_training_log(spark: SparkSession, sf: str) -> DataFrame:
    """Mean loss of the updates since the entry before, through all epochs of the causal flow. The pairs come with other column names."""
    pairs = _pairs(spark, sf).withColumnsRenamed({"inputs": "question", "targets": "answer"})
    options = replace(CAUSAL, input_column="question", output_column="answer", num_train_epochs=2, gradient_accumulation=3, logging_steps=4)
    return _rounded(flows.causal_flow(pairs, pairs, options)["train_log"], "mean_loss")


def masked_flow(spark: SparkSession, sf: str) -> DataFrame:
    """The whole masked flow on the documents: chunks, loss of every training epoch, perplexity of the held-out side."""
    result = flows.masked_flow(_corpus(spark, sf), OPTIONS)
    chunks = result["chunks"].agg(F.count(F.lit(1)).alias("n_chunks"))
    losses = _rounded(metrics.epoch_loss(result["train_losses"]), "train_loss")
    perplexity = _rounded(result["perplexity"], "perplexity", 4)
    return losses.withColumns({"n_chunks": chunks.scalar(), "perplexity": perplexity.scalar()})


# -- user functions ----------------------------------------------------------------------------


def map_windows(spark: SparkSession, sf: str) -> DataFrame:
    """A user function that turns each window of 1,000 documents into one row."""
    def measure(window: pa.Table) -> pa.Table:
        return pa.table(
            {
                "first_row": window["row_ord"].slice(0, 1),
                "n_rows": [window.num_rows],
                "n_chars": [pc.sum(pc.utf8_length(window["text"])).as_py()],
            }
        )

    return user.map_windows(_corpus(spark, sf), measure, "first_row bigint, n_rows bigint, n_chars bigint")


def collate_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A user function that pads each batch of encoded turns by itself and reports its shape."""
    turns = sorted_ordinal(_turns(spark, sf), ["conv_id", "turn"]).select("row_ord", "text")
    rows = encode_ids(turns, _words(spark, sf))

    def shape(batch: pa.Table) -> pa.Table:
        sizes = pc.list_value_length(batch["input_ids"])
        total = pc.sum(pc.list_flatten(batch["input_ids"])).as_py()
        return pa.table(
            {
                "batch_id": batch["batch_id"].slice(0, 1),
                "n_rows": pa.array([batch.num_rows], pa.int64()),
                "width": pa.array([pc.max(sizes).as_py()], pa.int64()),
                "id_sum": pa.array([total], pa.int64()),
            }
        )

    schema = "batch_id bigint, n_rows bigint, width bigint, id_sum bigint"
    return user.collate_batches(batching.batch_sequential(rows, EVAL_BATCH), shape, schema)


# -- sinks ------------------------------------------------------------------------------------


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Size and total of every table of a saved and reloaded model, and of its vocabulary."""
    chunks, words = _chunks(spark, sf)
    path = scratch_path(spark, "model")
    writers.save_model(ngram.fit_masked(chunks, flows.vocab_width(words)), words, path)
    model, saved_words = writers.load_model(spark, path)
    tables = {**model.tables(), "vocab": saved_words.withColumnRenamed("freq", "n")}
    parts = [
        t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("total")).withColumn("table_name", F.lit(name))
        for name, t in tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def model_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the models of two epochs saved to one path, the second of which was saved twice."""
    train, test, width = _split(spark, sf)
    words = _words(spark, sf)
    path = scratch_path(spark, "checkpoints")
    early, late = ngram.fit_causal(test, width), ngram.fit_trigram(train, width)
    for epoch, model in ((0, early), (1, early), (1, late)):
        writers.save_model(model, words, path, epoch)
    # Loaded and saved again to where it lies.
    writers.save_model(*writers.load_model(spark, path, 0), path, 0)
    writers.drop_old_versions(spark, path)
    rows = None
    for epoch in (0, 1):
        model, _ = writers.load_model(spark, path, epoch)
        for name, table in model.tables().items():
            part = table.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("total"))
            part = part.select(F.lit(epoch).alias("epoch"), F.lit(name).alias("table_name"), "n_rows", "total")
            rows = part if rows is None else rows.unionByName(part)
    return rows


def metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """Arguments and evaluation losses of a run, read back from its log."""
    path = scratch_path(spark, "log")
    arguments = {"batch_size": OPTIONS.batch_size, "mlm_probability": OPTIONS.mlm_probability}
    writers.start_run(spark, path, "run", {"stale": 1})
    writers.start_run(spark, path, "run", arguments)
    losses = _eval_losses(*_split(spark, sf))
    values = losses.select(
        F.lit(0).alias("epoch"), F.concat(F.lit("val_loss_"), F.col("batch_id")).alias("name"), F.col("loss").alias("value")
    )
    writers.log_metrics(values, path, "run")
    entries = writers.read_log(spark, path).filter("kind <> 'start'")
    return _rounded(entries, "value").select("run_id", "kind", "epoch", "name", "value")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Filter, vocabulary, encoding, chunks, split, causal fit, score: size and perplexity of the test side."""
    train, test, width = _split(spark, sf)
    batches = materialize(
        batching.batch_in_split_order(test.select("chunk_id", "input_ids"), OPTIONS.batch_size), "causal_eval"
    )
    losses = flows.causal_losses(batches, ngram.fit_causal(train, width))
    mean = F.sum(F.col("loss") * F.col("n_rows")) / F.sum("n_rows")
    return losses.agg(
        F.sum("n_rows").alias("n_chunks"), F.sum("n_pred").alias("n_pred"), F.round(F.exp(mean), 4).alias("perplexity")
    ).select(F.lit("test").alias("split"), "*")


QUERIES = {
    "csv_text_filter": csv_text_filter,
    "text_line_filter": text_line_filter,
    "filter_audit": filter_audit,
    "filter_audit_lines": filter_audit_lines,
    "filter_audit_observed": filter_audit_observed,
    "source_dispatch": source_dispatch,
    "quoted_csv_splits": quoted_csv_splits,
    "eval_text_scan": eval_text_scan,
    "pair_scan": pair_scan,
    "pair_scan_head": pair_scan_head,
    "pair_head_dropna": pair_head_dropna,
    "vocab_source": vocab_source,
    "chat_format_pairs": chat_format_pairs,
    "chat_format_full": chat_format_full,
    "vocab_build": vocab_build,
    "encode": encode_words,
    "subword_encode": subword_encode,
    "encode_fixed": encode_fixed_length,
    "pad_to_longest": pad_to_longest_in_batch,
    "chunk_tokens": chunk_tokens_query,
    "pack_causal": pack_causal,
    "split_exact": split_exact,
    "split_sizes": split_sizes,
    "train_eval_overlap": train_eval_overlap,
    "mask_eval": mask_eval,
    "mask_train_epochs": mask_train_epochs,
    "batch_shuffle": batch_shuffle,
    "batch_sequential": batch_sequential,
    "batch_shards": batch_shards,
    "step_budget": step_budget,
    "causal_fit": causal_fit,
    "trigram_fit": trigram_fit,
    "masked_fit": masked_fit,
    "causal_score": causal_score,
    "trigram_score": trigram_score,
    "masked_score": masked_score,
    "all_position_score": all_position_score,
    "perplexity_weighted": perplexity_weighted,
    "perplexity_gather": perplexity_gather,
    "perplexity_unweighted": perplexity_unweighted,
    "running_loss": running_loss,
    "epoch_loss": epoch_loss,
    "phase_loss": phase_loss,
    "chat_perplexity": chat_perplexity,
    "chat_training_log": chat_training_log,
    "masked_flow": masked_flow,
    "map_windows": map_windows,
    "collate_batches": collate_batches,
    "model_roundtrip": model_roundtrip,
    "model_epochs": model_epochs,
    "metrics_log": metrics_log,
    "flagship": flagship,
}
