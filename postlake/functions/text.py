"""Column helpers for text: stripping, tokens, accent folding, markup."""

import html
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Fixed value: a token is a run of letters, numbers and private-use characters.
TOKEN_PATTERN = r"[\p{L}\p{N}\p{Co}]+"

# Fixed value: combining marks that belong to the letter before them; other marks end a token.
MARK_PATTERN = (
    r"[\u0300-\u0304\u0306-\u030C\u030F\u0311\u031B"
    r"\u0323-\u0328\u032D\u032E\u0330\u0331]+"
)

# Fixed value: what counts as a tag.
TAG_PATTERN = r"<[^>]+>"


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (trim removes spaces only).

    The control characters 0x1C to 0x1F count as white space too.
    """
    return F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


@lru_cache
def _folding() -> tuple[str, str]:
    """Latin letters that decompose into one ASCII letter and one mark, and that letter."""
    accented, plain = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) == 2 and parts[0].isascii() and unicodedata.category(parts[1]) == "Mn":
            accented.append(chr(code))
            plain.append(parts[0])
    return "".join(accented), "".join(plain)


def normalise_words(col: Column, fold=True) -> Column:
    """Lower case, optionally without Latin accents."""
    lowered = F.lower(col)
    if not fold:
        return lowered
    folded = F.translate(F.regexp_replace(lowered, MARK_PATTERN, ""), *_folding())
    # As many bytes as characters: plain ASCII, nothing to fold.
    return F.when(F.octet_length(lowered) == F.length(lowered), lowered).otherwise(folded)


def tokens(col: Column, fold=True) -> Column:
    return F.regexp_extract_all(normalise_words(col, fold), F.lit(TOKEN_PATTERN), F.lit(0))


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def clean_markup(col: Column) -> Column:
    """Drop tags, then decode entities, so that an escaped tag survives as text."""
    return _unescape(F.regexp_replace(col, TAG_PATTERN, ""))


def escape_like(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
