"""Keys and numbers out of dirty text.

Spark's own ``trim`` strips spaces only, ``lpad`` truncates, and ``cast`` raises
under ANSI rules; these functions keep the meaning that tabular tools give the
same steps: strip all white space, pad without truncating, invalid to null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that tabular readers take as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Every string column with the missing-value texts as null."""
    return df.select(*[F.when(~F.col(f"`{n}`").isin(*tokens), F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def pad_key(value: Column, width: int = 5) -> Column:
    """Key text: stripped, a final ``.0`` dropped, zero-filled after any sign, never cut. Null stays null.

    The text goes through once: ``width`` zeros are put before it, and as many of
    them taken off again as leave ``width`` characters at least.
    """
    text = F.regexp_replace(value.cast("string"), r"^\s+|(?:\.0)?\s*$", "")
    filled = F.regexp_replace(F.concat(F.lit("0" * width), text), rf"^(?:0{{{width}}}(?=.{{{width}}})|0*?(?=.{{{width}}}$))", "")
    return F.regexp_replace(filled, r"^(0+)([+-])", "$2$1")


def pad_zip(value: Column) -> Column:
    """Five-character postal code; what follows in longer codes is dropped."""
    return F.substring(pad_key(value, 5), 1, 5)


def pad_state(value: Column) -> Column:
    """Two-character state code."""
    return F.lpad(strip(value.cast("string")), 2, "0")


def key_of_parts(state: Column, county: Column) -> Column:
    """Area key from a state and a county number."""
    return F.concat(pad_key(state, 2), pad_key(county, 3))


def to_number(text: Column) -> Column:
    """Double, or null where the text is no plain number."""
    return F.when(text.cast("string").rlike(NUMBER), text.try_cast("double"))


def to_integer(value: Column) -> Column:
    """Nullable 64-bit integer."""
    return value.try_cast("bigint")


def round_even(value: Column, decimals: int) -> Column:
    """Rounding half to even on the scaled binary value."""
    scale = float(10**decimals)
    return F.rint(value * scale) / scale


def contains_fold(text: Column, part: str) -> Column:
    """Whether ``text`` has ``part`` in either case; null is no."""
    return F.coalesce(F.lower(text).contains(part.lower()), F.lit(False))


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
