"""Rows that operators must stand."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

PROSE = (
    "the river ran past the old mill and the miller counted his sacks while rain fell on the roof "
    "and a boy with a lantern walked slowly up the hill to see whether the bridge would hold until "
    "morning came and the water went down again as it always had in the years before the flood"
)
OTHER = (
    "nobody at the station could say when the last train had left or why the clock above the gate "
    "showed a different hour on each of its four faces yet everybody agreed that somebody ought to "
    "write a letter about it and that the letter ought to be polite but firm and above all short"
)

#: Nulls in every column, empty and blank texts, ties, repeated rows, a very long text.
HARD = [
    (1, PROSE, "en", "src0", 10), (1, PROSE, "en", "src0", 10), (2, PROSE, "en", "src1", 10),
    (3, PROSE.replace("lantern", "torch"), "en", None, None), (4, OTHER, None, "src0", 5),
    (5, None, "en", "src0", 0), (6, "", "de", "src7", 0), (7, " \t\n\n ", "de", "src7", 0),
    (None, OTHER + " indeed", "en", "src0", 1), (None, None, None, None, None),
    (8, "word", "fr", "src2", 4), (9, "word", "fr", "src2", 4), (10, "!!! ??? 123", "es", "src3", 9),
    (11, " ".join(f"w{i % 5000}" for i in range(60_000)), "en", "src11", 1),
    (12, "\n".join([PROSE, OTHER, PROSE]), "en", "src4", 1),
    (13, "Ünïcödé wörds \U0001f600 漢字 and\x0bmore\x0cgaps\rhere", "de", "src5", 1),
]
