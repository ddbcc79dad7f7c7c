"""Typed ingest of loosely typed staging columns.

Staging tables are written by a loader that infers types, so one column
can arrive as text in one batch and as a double in the next.  Every cast
here dispatches on the *source* type so that both forms give the same
typed value.  All of it is built-in expressions (no Python UDF), so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _type(t: T.DataType | str) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


def double_text(d: Column) -> Column:
    """The shortest decimal text that reads back as the same double, as the
    reference database prints it: ``0.0005``, ``1e+15``, ``-0``, ``NaN``,
    ``Infinity``.  Built-in functions only, the cheap forms first: whole
    numbers by their integer, plain decimals as the runtime prints them; only
    other magnitudes have their exponent written out or padded, without a
    pattern.  The column stands in few places, so that a hash over many
    doubles still compiles.

    Digits are the runtime's; before Java 19 it has one too many for some
    doubles beyond 1e16 (about one in a hundred there) or below 1e-5.
    """
    text = d.cast("string")                 # 123.45, 5.0, 1.0E-5, 1.25E15
    size = F.abs(d)
    # exponents have two digits at least: those of 1e15 and more have them
    minus = F.when(size >= 1e-9, F.lit("e-0")).otherwise(F.lit("e-"))
    scaled = F.replace(F.replace(text, F.lit(".0E"), F.lit("E")), F.lit("E-"), minus)
    scaled = F.replace(scaled, F.lit("E"), F.lit("e+"))
    # fractions of the form 0.000..., and from 1e7 up to 1e15
    plain = F.rtrim(text.cast("decimal(38,22)").cast("string"), F.lit("0"))
    return (F.when((size < 1e15) & (F.rint(d) == d),
                   # -0 equals 0, but not in text
                   F.when((d == 0) & F.startswith(text, F.lit("-")), F.lit("-0"))
                   .otherwise(d.cast("bigint").cast("string")))
            .when((size >= 1e-3) & (size < 1e7), text)
            .when((size >= 1e-4) & (size < 1e15), plain).otherwise(scaled))


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    """Text form of a value as the hash and report strings need it.

    Doubles print as the reference database prints them (``double_text``).
    Strings pass through, everything else is cast to string.
    """
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return double_text(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c.cast("string")


def rounded_text(c: Column, decimals: int) -> Column:
    """``ROUND(x::NUMERIC, d)::TEXT`` for a double: the double goes to
    NUMERIC through its shortest text form (as the reference database
    converts), then rounds half away from zero; '0.9' -> '0.900'."""
    exact = c.cast("string").cast("decimal(38,18)")
    return F.round(exact, decimals).cast(f"decimal(38,{decimals})").cast("string")


def blank_cast(c: Column, target: T.DataType | str, source: T.DataType,
               on_error: str = "fail") -> Column:
    """``NULLIF(x::text, '')::target`` with source-type dispatch.

    * string source: ``''`` becomes NULL, the rest is cast; bad text
      raises (``on_error="fail"``, the reference aborts the run) or
      becomes NULL (``on_error="null"``).
    * fractional source into an integral target: a whole number casts,
      a value with a fraction raises (or becomes NULL), because the
      text round trip of 5.5 is not an integer.
    * anything else: a plain cast.
    """
    target = _type(target)
    lenient = on_error == "null"
    if isinstance(source, T.StringType):
        v = F.nullif(c, F.lit(""))
        return v.try_cast(target) if lenient else v.cast(target)
    if isinstance(target, _INTEGRAL) and isinstance(source, _FRACTIONAL):
        whole = c == F.floor(c)
        bad = (F.lit(None) if lenient else
               F.raise_error(F.concat(F.lit("blank_cast: not an integer: "),
                                      c.cast("string"))))
        return F.when(c.isNull(), F.lit(None).cast(target)) \
            .when(whole, c.cast(target)).otherwise(bad.cast(target))
    if isinstance(target, T.StringType):
        return canonical_text(c, source)
    return c.try_cast(target) if lenient else c.cast(target)


def round_half_even_cast(c: Column, target: T.DataType | str,
                         source: T.DataType) -> Column:
    """``x::INTEGER`` for a double: half-to-even rounding, not truncation."""
    target = _type(target)
    if isinstance(target, _INTEGRAL) and isinstance(source, _FRACTIONAL):
        return F.bround(c, 0).cast(target)
    return c.cast(target)


def cast_columns(df: DataFrame, targets: dict[str, T.DataType | str],
                 on_error: str = "fail", blank_safe: bool = True) -> DataFrame:
    """Cast many columns at once, keeping order and other columns."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for name, target in targets.items():
        src = fields[name]
        col = F.col(f"`{name}`")
        if blank_safe:
            exprs[name] = blank_cast(col, target, src, on_error)
        else:
            exprs[name] = round_half_even_cast(col, target, src)
    return df.withColumns(exprs)


def flag_bool(c: Column) -> Column:
    """``(x = 1)``: 1 -> true, other numbers -> false, NULL stays NULL."""
    return c == F.lit(1)


def guarded_date(c: Column) -> Column:
    """NULL or ``''`` -> NULL, otherwise cast to date."""
    return F.when(c.isNotNull() & (c != F.lit("")), c.cast("date"))


# Fixed value: the pattern a number-in-text must match before it is cast.
GUARDED_NUMBER_PATTERN = r"^\d+(\.\d+)?$"


def guarded_number(c: Column, default: float | None = None) -> Column:
    """Cast text to double only when it is plain digits with an optional
    fraction; ``15:32`` is not a number.  ``default`` replaces the rest."""
    matched = c.rlike(GUARDED_NUMBER_PATTERN)
    out = F.when(matched, c.cast("double"))
    if default is not None:
        out = out.otherwise(F.lit(float(default)))
    return out


def ordinal_label(n: Column) -> Column:
    """1 -> 1st, 2 -> 2nd, 3 -> 3rd, 11..13 -> th, else th; NULL -> NULL."""
    # remainder with the dividend's sign, as the reference's ``%``
    last = n % F.lit(10)
    last2 = n % F.lit(100)
    suffix = (F.when((last == 1) & (last2 != 11), F.lit("st"))
              .when((last == 2) & (last2 != 12), F.lit("nd"))
              .when((last == 3) & (last2 != 13), F.lit("rd"))
              .otherwise(F.lit("th")))
    return F.when(n.isNotNull(), F.concat(n.cast("string"), suffix))


def keep_required(df: DataFrame, columns) -> DataFrame:
    """Drop rows whose required (already cast) key columns are NULL: a blank
    text key cast to NULL never reaches the sync."""
    out = df
    for name in columns:
        out = out.where(F.col(f"`{name}`").isNotNull())
    return out


def with_missing_columns(df: DataFrame,
                         columns: dict[str, T.DataType | str]) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS``: add absent columns as typed NULLs."""
    present = set(df.columns)
    add = {name: F.lit(None).cast(_type(t))
           for name, t in columns.items() if name not in present}
    return df.withColumns(add) if add else df


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename (possibly dotted) source columns; others are kept."""
    return df.select([F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])
