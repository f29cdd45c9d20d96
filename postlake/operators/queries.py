"""Query tables: from one row per query to one row per unit.

A unit is what counts as one in the ranking: a word, a phrase, a prefix, a proximity group
or a phrase at the start of a field. Units sit in clauses. A post matches a query if every
clause holds, and a clause holds if one of its units matches or one of its negated units
does not. Any AND / OR / NOT of units can be written as such clauses.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postlake.functions.text import tokens

# Fixed value: word gap of a proximity group when none is given.
DEFAULT_NEAR = 10

NO_TEXTS = "array<string>"


def query_units(queries: DataFrame, fold: bool = True) -> DataFrame:
    """Units of a query table.

    Columns, all but query_id optional: `must`, `should`, `must_not` (texts; one of
    several words is a phrase), `phrase` (words in order), `prefix` (texts whose last word
    is a prefix), `near` (single words within `near_k` of each other), `initial` (texts
    that open a field), `field` (only look there). All are required together, except that
    one of `should` is enough and none of `must_not` may match.
    """

    def texts(name) -> Column:
        present = F.col(name) if name in queries.columns else F.lit(None)
        return F.coalesce(present.cast(NO_TEXTS), F.array().cast(NO_TEXTS))

    def unit(role, kind, words) -> Column:
        return F.struct(F.lit(role).alias("role"), F.lit(kind).alias("kind"), words.alias("words"))

    def each(name, role, kind) -> Column:
        return F.transform(texts(name), lambda text: unit(role, kind, tokens(text, fold)))

    def together(name, kind) -> Column:
        words = F.flatten(F.transform(texts(name), lambda text: tokens(text, fold)))
        return F.filter(F.array(unit("must", kind, words)), lambda _: F.size(texts(name)) > 0)

    units = F.concat(
        each("must", "must", "phrase"),
        each("should", "should", "phrase"),
        each("must_not", "must_not", "phrase"),
        together("phrase", "phrase"),
        each("prefix", "must", "prefix"),
        together("near", "near"),
        each("initial", "must", "initial"),
    )
    # A text without a word matches nothing; to forbid it forbids nothing.
    usable = F.filter(units, lambda u: (F.size(u["words"]) > 0) | (u["role"] != "must_not"))
    near_k = F.col("near_k") if "near_k" in queries.columns else F.lit(None)
    field = F.col("field") if "field" in queries.columns else F.lit(None)
    return queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.posexplode(usable).alias("unit", "u"),
        F.coalesce(near_k.cast("int"), F.lit(DEFAULT_NEAR)).alias("near_k"),
        field.cast("string").alias("field"),
    ).select(
        "query_id",
        "unit",
        F.when(F.col("u.role") == "should", F.lit(-1)).otherwise(F.col("unit")).alias("clause"),
        (F.col("u.role") == "must_not").alias("negated"),
        "u.kind",
        "u.words",
        "near_k",
        "field",
    )


def unit_words(units: DataFrame) -> DataFrame:
    """One row per word of a unit, saying whether the word is a prefix."""
    return units.select(
        "query_id", "unit", "kind", "near_k", F.col("field").alias("only_field"),
        F.size("words").alias("n_words"), F.posexplode("words").alias("word_no", "word"),
    ).withColumn(
        "is_prefix", (F.col("kind") == "prefix") & (F.col("word_no") == F.col("n_words") - 1)
    )


def with_clause_sizes(units: DataFrame) -> DataFrame:
    """Units with the number of negated units in their clause (n_negated), and of clauses
    (n_clauses) and of clauses with a negated unit (n_preset) in their query."""
    clauses = units.groupBy("query_id", "clause").agg(F.count_if("negated").alias("n_negated"))
    queries = clauses.groupBy("query_id").agg(
        F.count("*").alias("n_clauses"), F.count_if(F.col("n_negated") > 0).alias("n_preset")
    )
    return units.join(clauses, ["query_id", "clause"]).join(queries, "query_id")


def unit_shapes(units: DataFrame) -> set:
    """{(kind, several words, prefix of one letter)} of a table of any size: a few rows."""
    letter = (F.col("kind") == "prefix") & (F.length(F.try_element_at("words", F.lit(-1))) == 1)
    several = F.size("words") > 1
    return {tuple(row) for row in units.select("kind", several, F.coalesce(letter, F.lit(False))).distinct().collect()}
