"""JSON leaves kept as VARIANT: their type, text, truth and number.

A leaf keeps its JSON type, so the quoted text "0" and the number 0 stay apart. `leaf`
is taken out of the parsed item once; the other helpers work on its result.
"""

from pyspark.sql import Column, functions as F

# Texts of unquoted leaves that count as "nothing there".
EMPTY_UNQUOTED = ["false", "0", "-0", "0.0", "-0.0", "[]", "{}"]


def leaf(variant: Column) -> Column:
    """struct(text, quoted): null text for a missing or null leaf."""
    return F.struct(
        F.try_variant_get(variant, "$", "string").alias("text"),
        (F.schema_of_variant(variant) == "STRING").alias("quoted"),
    )


def is_text(value: Column) -> Column:
    return F.coalesce(value["quoted"], F.lit(False))


def is_truthy(value: Column) -> Column:
    there = F.when(value["quoted"], value["text"] != "").otherwise(~value["text"].isin(EMPTY_UNQUOTED))
    return F.coalesce(there, F.lit(False))


def truthy_text(value: Column) -> Column:
    """The leaf as text, null unless truthy."""
    return F.when(is_truthy(value), value["text"])


def whole_number(value: Column) -> Column:
    """0 when there is nothing, null when there is something that is not a number.

    A JSON number with a fraction is cut; quoted, it is not a whole number.
    """
    text = F.trim(value["text"])
    unquoted = F.when(text == "true", F.lit(1)).otherwise(text.try_cast("double").try_cast("bigint"))
    number = F.coalesce(text.try_cast("bigint"), F.when(~value["quoted"], unquoted))
    return F.when(is_truthy(value), number).otherwise(F.lit(0)).cast("bigint")
