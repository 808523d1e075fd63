"""Race-time conversion and formatting.

Three converters exist in the reference and give different answers on edge
cases; one function with a ``mode`` covers them:

* ``"ingest"`` (also used before modelling): empty text, missing and numeric
  zero become NULL; ``M:SS.ss`` or ``SS.ss`` otherwise, rounded to 2 digits;
  anything else (three colon parts, bad text) is NULL.
* ``"table"``: numbers pass through (zero stays 0.0); text is stripped,
  ``M:SS.ss`` converted without rounding, other text coerced, bad text NULL
  (the reference raises on bad text containing ':'; here it is NULL).
* ``"strict"``: as ``table`` but minutes may be fractional and bad text
  raises an error, as the notebook's converter does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.functions.text import PY_SPACE_CLASS

# Numbers Python's int()/float() accept (underscores and nan/inf left out);
# int()/float() ignore surrounding whitespace, so the patterns allow it.
_WS = PY_SPACE_CLASS + "*"
_INT = r"[+-]?[0-9]+"
_NUM = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
PLAIN_TEXT = f"^{_WS}({_NUM}){_WS}$"
COLON_INT_TEXT = f"^{_WS}({_INT}){_WS}:{_WS}({_NUM}){_WS}$"      # int(m) * 60 + float(s)
SIMPLE_TEXT = r"^(?:[0-9]+:)?[0-9]+(?:\.[0-9]*)?\z"                # read without the patterns above, to the same value
COLON_NUM_TEXT = f"^{_WS}({_NUM}){_WS}:{_WS}({_NUM}){_WS}$"      # float(m) * 60 + float(s)


def to_double(c: Column) -> Column:
    """numeric coercion, bad text to NULL (``try_cast`` alone accepts '1d', 'nan')."""
    s = c.cast("string")
    return F.regexp_extract(s, PLAIN_TEXT, 1).try_cast("double")


def _colon_value(s: Column, pattern: str, minutes_type: str) -> Column:
    mins = F.regexp_extract(s, pattern, 1).try_cast(minutes_type)
    secs = F.regexp_extract(s, pattern, 2).try_cast("double")
    return mins * 60 + secs


def time_to_seconds(c: Column, mode: str = "ingest", numeric: bool = False) -> Column:
    """Seconds from a race time; ``numeric=True`` when the column is already a number."""
    if mode not in ("ingest", "table", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    if numeric:
        v = F.when(~F.isnan(c.cast("double")), c.cast("double"))
        if mode == "ingest":
            return F.when(v != 0, F.round(v, 2))
        return v
    s = c.cast("string")
    has_colon = s.contains(":")
    minutes_type = "double" if mode == "strict" else "bigint"
    pattern = COLON_NUM_TEXT if mode == "strict" else COLON_INT_TEXT
    simple = F.when(has_colon, F.substring_index(s, ":", 1).try_cast(minutes_type) * 60 + F.substring_index(s, ":", -1).try_cast("double")).otherwise(
        s.try_cast("double"))
    other = F.when(has_colon, _colon_value(s, pattern, minutes_type)).otherwise(to_double(s))
    value = F.when(s.rlike(SIMPLE_TEXT), simple).otherwise(other)
    if mode == "ingest":
        # empty text is missing; the result is rounded to 2 digits
        return F.when(s != "", F.round(value, 2))
    if mode == "strict":
        bad = s.isNotNull() & value.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit("bad time text: "), s))
                      .cast("double")).otherwise(value)
    return value


def convert_time_columns(df: DataFrame, cols: list[str], mode: str) -> DataFrame:
    """Convert the listed columns that exist, choosing the path by column type.

    The text columns are converted as one array, by one expression for all of them, and pass through a generator of
    their own (a one-element ``explode``): each conversion runs once per row, as predicates on the results (``dropna``
    and the like) cannot be pushed beneath it, and no generated method grows with the number of columns (the JVM
    does not compile methods over 8,000 bytes).
    """
    types = {f.name: f.dataType for f in df.schema.fields if f.name in cols}
    if not types:
        return df
    text = [n for n, t in types.items() if not isinstance(t, T.NumericType)]
    out = df
    if text:
        values = F.transform(F.array(*[F.col(n).cast("string") for n in text]), lambda s: time_to_seconds(s, mode))
        out = df.select(*[c for c in df.columns if c not in text], F.explode(F.array(values)).alias("_times"))
    made = {n: F.get("_times", text.index(n)) if n in text else time_to_seconds(F.col(n), mode, numeric=True) for n in types}
    return out.select(*[made[c].alias(c) if c in made else c for c in df.columns])


def centis(c: Column) -> Column:
    """Seconds as integer hundredths (exact sums and means over 2-digit times)."""
    return F.round(c * 100).cast("bigint")


def small_idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative integers below 2**53 (plain long arithmetic)."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative integers (no double rounding at any size)."""
    exact = (a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")
    return exact.cast("bigint")


def half_up_mean(sum_col: Column, n_col: Column, digits: int) -> Column:
    """Mean of integer hundredths rounded half up to ``digits`` decimals of a second.

    ``digits=2`` rounds to whole hundredths, ``digits=3`` to tenths of a hundredth.
    Returns a double in seconds: floor((2*k*sum + n) / 2n) / (100*k), k = 10**(digits-2).
    """
    k = 10 ** (digits - 2)
    q = idiv(sum_col * (2 * k) + n_col, n_col * 2)
    return q / F.lit(float(100 * k))


def format_seconds(c: Column) -> Column:
    """``226.88s (3:46.88)``; minutes = floor(s/60), remainder = s mod 60 (Python's sign rule)."""
    s = c.cast("double")
    minutes = F.floor(s / 60).cast("bigint")
    remainder = F.pmod(s, F.lit(60.0))
    return F.format_string("%.2fs (%d:%05.2f)", s, minutes, remainder)


def bad_time_counts(df: DataFrame, cols: list[str], mode: str = "table") -> DataFrame:
    """F02 diagnostics: per column, how many non-empty values the converter turned into NULL
    (the reference raised on some of them).  One aggregate pass, one row."""
    aggs = []
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        numeric = isinstance(f.dataType, T.NumericType)
        raw = F.col(f.name)
        present = raw.isNotNull() if numeric else (raw.isNotNull() & (F.trim(raw.cast("string")) != ""))
        bad = present & time_to_seconds(raw, mode, numeric=numeric).isNull()
        aggs.append(F.count_if(bad).cast("bigint").alias(f.name))
    return df.agg(*aggs)
