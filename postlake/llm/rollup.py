"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A store is a folder with two tables, both cut by batch number. `ledger/seq=n` holds the
counts of the documents that batch n changed, `deltas/seq=n` the signed sums of the batch.
Totals are the sum of all deltas. A batch is computed against the ledger of lower numbers
only, writes its ledger first and its deltas last, and counts as committed when the deltas
are complete. So a batch that failed half-way is simply run again, and one that is committed
already changes nothing. A batch may arrive after batches of higher numbers: for documents that
those touch, its deltas also undo, as of the first such batch (`at`), what it changes, as that
batch took off the count before it. Batches are committed one at a time.

A change is a row (doc_id, action, text, source, lang), with action `insert`, `revise` or
`delete`. What a document counted before is taken off, what it counts now is added: a revised
count, another source or another language is both. Inserting a known document revises it;
deleting an unknown one does nothing.

Edge cases: a null text has no tokens but is a document; null sources and languages are
groups of their own; a null doc_id is a document of its own; of several changes to one
document in a batch the one with the highest `pos` counts (a tie is broken by the row's
content); unknown actions raise when the batch is written; further columns are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ["source", "lang", "tokenizer"]
ACTIONS = ("insert", "revise", "delete")
GAP = "[ \\t-\\r]+"
GAP_CHARACTERS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(GAP_CHARACTERS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, GAP))).cast("bigint")


def byte_count(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def piece_count(text: Column) -> Column:
    """Runs of letters, single digits and single other characters."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}|[^\p{L}\p{N} \t-\r]")).cast("bigint")


#: Tokenizer versions by name; a new version is a new name.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "bytes@1": byte_count, "pieces@1": piece_count, "words@1": word_count,
}


def _committed(spark: SparkSession, store: str) -> list[int]:
    jvm = spark._jvm.org.apache.hadoop.fs
    pattern = jvm.Path(f"{store}/deltas/seq=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().removeprefix("seq=")) for f in found)


#: Of the deltas; those of stores written without `at` hold from their own batch on.
DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, at bigint, seq int"


def _read(spark: SparkSession, store: str, name: str, seqs: list[int], schema: str | None = None) -> DataFrame:
    paths = [f"{store}/{name}/seq={n}" for n in seqs]
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("basePath", f"{store}/{name}").parquet(*paths)


def _counted(changes: DataFrame, tokenizers) -> DataFrame:
    """One row per document and tokenizer with its state after the batch."""
    known = F.when(F.col("action").isin(*ACTIONS), F.col("action")).otherwise(
        F.raise_error(F.concat(F.lit("unknown action: "), F.coalesce("action", F.lit("null"))))
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = F.array(*[
        F.struct(F.lit(name).alias("tokenizer"), count(text).alias("n_tokens")) for name, count in tokenizers.items()
    ])
    pos = F.col("pos") if "pos" in changes.columns else F.lit(0)
    slim = changes.select(
        "doc_id", F.struct(pos.cast("bigint").alias("pos"), (known != "delete").alias("live"), "source", "lang", counts.alias("counts")).alias("row")
    )
    last = slim.where("doc_id is not null").groupBy("doc_id").agg(F.max("row").alias("row"))
    return last.union(slim.where("doc_id is null")).select("doc_id", "row.live", "row.source", "row.lang", F.explode("row.counts").alias("c")).select(
        "doc_id", "c.tokenizer", "source", "lang", "c.n_tokens", "live"
    )


def commit_batch(spark: SparkSession, store: str, seq: int, changes: DataFrame, tokenizers=None) -> bool:
    """Apply a batch of changes; False if it was committed before, and then nothing is done."""
    committed = _committed(spark, store)
    if seq in committed:
        return False
    _counted(changes, tokenizers or TOKENIZERS).write.mode("overwrite").parquet(f"{store}/ledger/seq={seq}")
    new = spark.read.parquet(f"{store}/ledger/seq={seq}")
    signed = new.where("live").select("doc_id", *KEYS, F.lit(1).cast("bigint").alias("n_docs"), "n_tokens")
    # The ledger is the streamed side; only documents of the batch leave it.
    touched = new.select("doc_id", "tokenizer").where("doc_id is not null")
    earlier, later = [n for n in committed if n < seq], [n for n in committed if n > seq]
    if earlier:
        old = (
            _read(spark, store, "ledger", earlier)
            .join(touched, ["doc_id", "tokenizer"], "left_semi")
            .groupBy("doc_id", "tokenizer")
            .agg(F.max_by(F.struct("source", "lang", "n_tokens", "live"), "seq").alias("row"))
            .where("row.live")
        )
        signed = signed.union(old.select(
            "doc_id", "row.source", "row.lang", "tokenizer", F.lit(-1).cast("bigint"), -F.col("row.n_tokens")
        ))
    signed = signed.withColumn("at", F.lit(seq).cast("bigint"))
    if later:
        # The next batch of a document took off its count before this one, not after it.
        following = _read(spark, store, "ledger", later).join(touched, ["doc_id", "tokenizer"], "left_semi").groupBy(
            "doc_id", "tokenizer"
        ).agg(F.min("seq").cast("bigint").alias("next"))
        signed = signed.union(signed.join(following, ["doc_id", "tokenizer"]).select(
            "doc_id", *KEYS, -F.col("n_docs"), -F.col("n_tokens"), "next"
        ))
    signed.groupBy(*KEYS, "at").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.mode(
        "overwrite"
    ).parquet(f"{store}/deltas/seq={seq}")
    return True


def totals(spark: SparkSession, store: str, until: int | None = None) -> DataFrame:
    """(source, lang, tokenizer, n_docs, n_tokens) of every group that has documents, as of a
    batch or of the last one."""
    seqs = [n for n in _committed(spark, store) if until is None or n <= until]
    if not seqs:
        return spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint")
    return (
        _read(spark, store, "deltas", seqs, DELTAS)
        .where(F.lit(until is None) | (F.coalesce("at", "seq") <= F.lit(until)))
        .groupBy(*KEYS)
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        .where("n_docs <> 0 or n_tokens <> 0")
    )
