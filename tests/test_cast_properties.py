"""Cast helpers against small Python references on random inputs."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import canonical_text, guarded_number, ordinal_label


def py_ordinal(n):
    if n is None:
        return None
    last, last2 = math.fmod(n, 10), math.fmod(n, 100)   # remainder, sign of n
    if last == 1 and last2 != 11:
        suffix = "st"
    elif last == 2 and last2 != 12:
        suffix = "nd"
    elif last == 3 and last2 != 13:
        suffix = "rd"
    else:
        suffix = "th"
    return f"{n}{suffix}"


def py_guarded(text):
    if text is not None and re.fullmatch(r"\d+(\.\d+)?", text):
        return float(text)
    return None


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-100_000, 100_000)), min_size=50, max_size=200))
def test_ordinal_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n int")
    got = [r[0] for r in df.select(ordinal_label(F.col("n"))).collect()]
    assert got == [py_ordinal(v) for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.from_regex(r"[0-9:.\-a ]{0,8}", fullmatch=True)),
                min_size=50, max_size=200))
def test_guarded_number_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(guarded_number(F.col("t"))).collect()]
    assert got == [py_guarded(v) for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=20, max_size=100))
def test_integral_doubles_print_without_fraction(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r[0] for r in df.select(canonical_text(F.col("x"), T.DoubleType())).collect()]
    assert got == [str(v) for v in values]


def py_blank_int(text):
    if text is None or text == "":
        return None
    s = text.strip()
    if re.fullmatch(r"[+-]?\d+", s) and -2**31 <= int(s) < 2**31:
        return int(s)
    return None


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.just(""), st.integers(-10**6, 10**6).map(str),
                          st.from_regex(r"[0-9a-z.]{1,6}", fullmatch=True)),
                min_size=50, max_size=200))
def test_blank_cast_lenient_matches_reference(spark, values):
    from tidemark.functions.casts import blank_cast
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(
        blank_cast(F.col("t"), "int", T.StringType(), on_error="null")).collect()]
    assert got == [py_blank_int(v) for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**9, 10**9)),
                          st.one_of(st.none(), st.text("abc|xyz ", max_size=5))),
                min_size=20, max_size=100))
def test_row_hash_matches_md5(spark, rows):
    import hashlib

    from tidemark.functions.hashing import row_hash
    df = spark.createDataFrame(rows, "a bigint, b string")
    got = [r[0] for r in df.select(row_hash(df.schema, ["a", "b"])).collect()]
    want = [hashlib.md5("|".join("" if x is None else str(x) for x in r).encode()).hexdigest()
            for r in rows]
    assert got == want
