"""One query per operator over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.llm.bpe import byte_bpe, digests
from postlake.llm.langid import identify_languages
from postlake.llm.mixture import Weights, mix
from postlake.llm.ngram_lm import score_texts
from postlake.llm.pivots import near_vectors
from postlake.llm.quality import POLICIES, ablations, apply_policies, ledger, quality_rules, read_ledger, write_ledger
from postlake.llm.rollup import commit_batch, totals
from postlake.llm.runs import periodic_runs
from postlake.llm.setjoin import jaccard_components
from postlake.llm.toolcalls import link_tool_calls
from postlake.llm.units import substring_dedup
from postlake.llm.whitening import whiten
from postlake.llm.zstd_quality import learn, score_quality
from postlake.session import scratch_path

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits", "n_lines", "n_capitals",
    )


@query
def quality_ablations(spark, sf_dir):
    """Per policy and rule of it, from a stored ledger: documents that fail it, that fail it
    alone, and that would be kept without it; and how many the policy keeps."""
    path = scratch_path(spark, "quality-ledger")
    write_ledger(ledger(table(spark, sf_dir, "documents")), path)
    stored, out = read_ledger(spark, path), None
    for policy in POLICIES:
        name = f"{policy.name}@{policy.version}"
        kept = apply_policies(stored, [policy]).agg(F.count_if(f"kept_{policy.name}_v{policy.version}").alias("n_kept"))
        rows = ablations(stored, policy).join(F.broadcast(kept)).select(F.lit(name).alias("policy"), "*")
        out = rows if out is None else out.union(rows)
    return out


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op3_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op4_token_counts(spark, sf_dir):
    """A store filled by three batches, the last two of which arrive twice: all documents are
    inserted, then some are revised, moved to another source or deleted."""
    docs = table(spark, sf_dir, "documents")
    store = scratch_path(spark, "token-store")
    inserted = docs.withColumn("action", F.lit("insert"))
    revised = docs.where("doc_id % 7 = 0").select(
        "doc_id", F.lit("revise").alias("action"), F.concat_ws(" ", "text", "text").alias("text"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("moved")).otherwise(F.col("source")).alias("source"), "lang",
    )
    deleted = docs.where("doc_id % 10 = 3").select("doc_id", F.lit("delete").alias("action"), F.lit("").alias("text"), "source", "lang")
    for seq, changes in ((1, inserted), (2, revised), (3, deleted), (2, revised), (3, deleted)):
        commit_batch(spark, store, seq, changes)
    return totals(spark, store)


@query
def op5_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_units", "n_removed", "n_removed_words", "removed_spans"
    )


def domain_of_source() -> Column:
    """A made-up assignment of the given sources to domains."""
    number = F.try_to_number(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("999999999"))
    return F.when(number < 5, "web").when(number < 10, "books").when(number < 15, "reference").otherwise("other")


MIX = Weights(domain={"web": 3, "books": 4, "reference": 2}, lang={"en": 4, "de": 2, "fr": 2}, source={"src0": 3, "src6": 5})


@query
def op9_source_mixture(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), domain_of_source(), 60, MIX, epochs=2, seed=17).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "copies"
    )


#: Calls and results for the tools below, made from the turns of `conversations` in SQL that
#: Spark and DuckDB share: some arguments are broken, some calls wait for others or for each
#: other, some results are missing, repeated or belong to no call.
CALLS_SQL = """
SELECT conv_id, concat('call_', conv_id, '_', turn, '_', k) AS call_id, turn, name,
  CASE
    WHEN name = 'search' AND (conv_id + turn) % 13 = 0 THEN '{ "limit": 3 }'
    WHEN name = 'search' AND (conv_id + turn) % 11 = 0 THEN concat('{"query": "', word, '", "limit": "3"}')
    WHEN name = 'search' THEN concat('{ "query": "', word, '",  "limit": ', turn + k + 1, ' }')
    WHEN name = 'calculate' THEN concat('{"precision": 2, "expression": "', turn, ' + ', conv_id, '"}')
    WHEN name = 'lookup' AND (conv_id + turn) % 7 = 0 THEN concat('{"id": ', conv_id, ', ')
    WHEN name = 'lookup' THEN concat('{"id": ', conv_id, ', "exact": ', CASE WHEN k = 1 THEN 'false' ELSE 'true' END, '}')
    ELSE concat('{"b": [', k, ', {"d": null, "c": "', word, '"}], "a": ', turn, '}')
  END AS arguments,
  CASE WHEN k > 0 THEN concat('call_', conv_id, '_', turn, '_', k - 1)
    WHEN (conv_id + turn) % 17 = 0 AND n > 1 THEN concat('call_', conv_id, '_', turn, '_', 1) END AS needs
FROM (
  SELECT conv_id, turn, n, k, word, CASE (conv_id + turn + k) % 5 WHEN 0 THEN 'search' WHEN 1 THEN 'calculate'
    WHEN 2 THEN 'lookup' WHEN 3 THEN 'search' ELSE 'browse' END AS name
  FROM (
    SELECT conv_id, turn, n, word, explode(sequence(0, CAST(n - 1 AS INT))) AS k
    FROM (
      SELECT conv_id, turn, 1 + (conv_id + turn) % 3 AS n,
        coalesce(regexp_extract(text, '[A-Za-z]+', 0), '') AS word
      FROM conversations WHERE role = 'assistant'
    ) turns
  ) numbered
) named
"""
RESULTS_SQL = """
SELECT conv_id, call_id, turn + 1 AS turn, concat('found "', name, '" at ', turn) AS content
FROM calls WHERE (conv_id * 3 + turn + length(name)) % 6 <> 0
UNION ALL
SELECT conv_id, call_id, turn + 2, 'again' FROM calls WHERE (conv_id + turn) % 8 = 0
UNION ALL
SELECT conv_id, concat('call_', conv_id, '_', turn, '_9'), turn, 'late'
FROM conversations WHERE role = 'user' AND (conv_id + turn) % 9 = 0
"""
SCHEMAS = {
    "search": {"limit": ("integer", False), "query": ("string", True)},
    "calculate": {"expression": ("string", True), "precision": ("integer", False)},
    "lookup": {"exact": ("boolean", False), "id": ("integer", True)},
}


@query
def op10_chat_tool_calls(spark, sf_dir):
    # Repeated rows of a turn are one turn.
    turns = table(spark, sf_dir, "conversations").dropDuplicates(["conv_id", "turn", "role", "text"])
    named = lambda sql: sql.replace("{", "{{").replace("}", "}}").replace("FROM conversations", "FROM {turns}")
    calls = spark.sql(named(CALLS_SQL), turns=turns)
    results = spark.sql(named(RESULTS_SQL).replace("FROM calls", "FROM {calls}"), turns=turns, calls=calls)
    linked = calls.withColumn("depends_on", F.when(F.col("needs").isNotNull(), F.array("needs")))
    return link_tool_calls(linked, results, SCHEMAS)


def tokenizer_file() -> tuple[str, str]:
    """(rank file, pattern) of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op6_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(byte_bpe(docs, *tokenizer_file())).drop("text")


@query
def op7_ngram_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


@query
def op11_embedding_whitening(spark, sf_dir):
    found = whiten(table(spark, sf_dir, "embeddings"), k=4)
    each = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


def planted_period(text: Column, doc_id: Column) -> Column:
    """The text, or for one in ten documents (by a hash of the id) its words with a cycle from
    some word on: word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)


@query
def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_period(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs).drop("text")
    # The greatest length / period, compared as whole numbers; ties go to the earlier run.
    best = F.reduce(
        "runs", F.try_element_at("runs", F.lit(1)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


@query
def op13_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    scored = score_quality(docs, learn(docs, table(spark, sf_dir, "labels"), training))
    return scored.select(
        "doc_id", F.coalesce(~training, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference"
    )
