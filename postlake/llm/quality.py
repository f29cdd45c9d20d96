"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
rule that failed (`fail_bits`). Policies are versioned sets of rules; applying one is a
bitwise AND, so on a stored ledger (`write_ledger`, `read_ledger`) a new policy or an ablation
never reads a text again. Ablations count the
distinct bit patterns under a policy's mask first, which is one small aggregation whatever
the number of rules.

Edge cases: a null text counts as empty, has no words and fails `few_words`; null or
repeated ids and further columns pass through; columns of the input that are named like the
ledger's own are replaced.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.llm.columns import unused

#: What separates words: space and the characters 0x09 to 0x0D.
GAP = "[ \\t-\\r]+"
GAP_CHARACTERS = " \t\n\x0b\f\r"

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
]


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails` is true. Bits are never given to another rule."""

    bit: int
    name: str
    fails: str


RULES = [
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 12 * n_words"),
    Rule(6, "capitals", "100 * n_capitals > 40 * word_chars"),
]


@dataclass(frozen=True)
class Policy:
    """The rules a document must not fail, under a version."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules=None) -> int:
        known = {rule.name: rule.bit for rule in rules or RULES}
        return sum(1 << known[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 2, tuple(rule.name for rule in RULES))
POLICIES = [BASE, Policy("standard", 1, ("few_words", "repeated_words", "symbols", "repeated_lines")), STANDARD]


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def measure(docs: DataFrame) -> DataFrame:
    """The input with the measurements of each text, all long.

    n_repeat_words counts the words that lie in a window of three words found twice or more
    in the text. The windows of a text become 64-bit hashes; where one repeats, the hashes are
    sorted with their positions, so equal ones are neighbours: n log n in the length of one
    text, and nothing leaves its row. (Two different windows of a text of a million words meet
    with a chance of 3e-8.)
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(GAP_CHARACTERS))
    kept = docs.drop(*[c for c in MEASURES if c in docs.columns])
    own = [F.col(f"`{c}`") for c in kept.columns]
    words, lines, windows, placed, starts = unused(kept.columns, "words", "lines", "windows", "placed", "starts")
    counted = kept.withColumns({
        words: F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP)),
        lines: F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]")),
    }).select(
        *own,
        words,
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        _length_without(text, "[^#*$%&|<>]+").alias("n_symbols"),
        _length_without(text, "[^A-Z]+").alias("n_capitals"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
    )
    at = lambda i: F.get(words, i)
    hashed = counted.withColumn(
        windows,
        F.when(
            F.size(words) > 3,
            F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                        lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop(words)
    # Most texts repeat no window and stop at the comparison of sizes.
    ordered = hashed.withColumn(
        placed,
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop(windows)
    same = lambda x, j: F.coalesce(x["h"] == F.get(placed, j)["h"], F.lit(False))
    repeated = ordered.withColumn(
        starts,
        F.sort_array(F.transform(F.filter(placed, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])),
    )
    # Each start covers three words, or fewer where the next start comes sooner.
    covered = F.aggregate(
        F.transform(starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return repeated.select(*own, *[c for c in MEASURES if c != "n_repeat_words"],
                           covered.alias("n_repeat_words"))


def ledger(docs: DataFrame, rules=None) -> DataFrame:
    """The input with the measurements and `fail_bits` (long), one bit per failed rule."""
    bits = None
    for rule in rules or RULES:
        bit = F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    measured = measure(docs)
    # Filters on the ledger must not be moved below the measurements, where each use of a
    # measurement would compute it anew; Spark moves none past a column like this one.
    once = F.when(F.monotonically_increasing_id() >= 0, bits)
    return measured.drop("fail_bits").withColumn("fail_bits", once)


def write_ledger(rows: DataFrame, path: str) -> None:
    """Stores a ledger without the texts it was measured from."""
    rows.drop("text").write.mode("errorifexists").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger: policies and ablations read its bits, no text and no rule."""
    return spark.read.parquet(path)


def passes(policy: Policy, rules=None) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def apply_policies(rows: DataFrame, policies) -> DataFrame:
    """The ledger with one boolean per policy, named kept_<name>_v<version>."""
    return rows.withColumns({f"kept_{p.name}_v{p.version}": passes(p) for p in policies})


def ablations(rows: DataFrame, policy: Policy, rules=None) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that would be
    kept without it. Reads the ledger only."""
    known = {rule.name: rule.bit for rule in rules or RULES}
    patterns = rows.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")).alias("bits")
    ).agg(F.count("*").alias("n"))
    # Few rows by now: each pattern is looked at under every rule.
    listed = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << known[name]).cast("bigint").alias("bit")) for name in policy.rules
    ])
    hit = F.col("bits").bitwiseAND(F.col("bit"))
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return (
        patterns.select("bits", "n", F.explode(listed).alias("r")).select("bits", "n", "r.rule", "r.bit")
        .groupBy("rule")
        .agg(
            F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when((hit != 0) & (rest == 0), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def quality_rules(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with `base_failed` and the policy's verdict `kept`."""
    rows = ledger(docs)
    return rows.drop("base_failed", "kept").withColumns(
        {"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy)}
    )
