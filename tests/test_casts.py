import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import (blank_cast, canonical_text, flag_bool,
                                      guarded_date, guarded_number, ordinal_label,
                                      rename_columns, round_half_even_cast,
                                      with_missing_columns)
from tidemark.functions.hashing import row_hash


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_blank_cast_text(spark):
    df = one_col(spark, ["5", "", None, " 7"], T.StringType())
    out = [r[0] for r in df.select(blank_cast(F.col("x"), "int", T.StringType())).collect()]
    assert out == [5, None, None, 7]


def test_blank_cast_text_bad_raises(spark):
    df = one_col(spark, ["abc"], T.StringType())
    with pytest.raises(Exception):
        df.select(blank_cast(F.col("x"), "int", T.StringType())).collect()
    out = df.select(blank_cast(F.col("x"), "int", T.StringType(), on_error="null")).first()[0]
    assert out is None


def test_blank_cast_double_source(spark):
    df = one_col(spark, [5.0, None], T.DoubleType())
    out = [r[0] for r in df.select(blank_cast(F.col("x"), "bigint", T.DoubleType())).collect()]
    assert out == [5, None]
    bad = one_col(spark, [5.5], T.DoubleType())
    with pytest.raises(Exception):
        bad.select(blank_cast(F.col("x"), "bigint", T.DoubleType())).collect()


def test_round_half_even(spark):
    df = one_col(spark, [2.5, 3.5, -2.5, 2.4], T.DoubleType())
    out = [r[0] for r in df.select(round_half_even_cast(F.col("x"), "int", T.DoubleType())).collect()]
    assert out == [2, 4, -2, 2]


def test_canonical_text(spark):
    df = one_col(spark, [3.0, 2.5, None, -4.0, 0.1], T.DoubleType())
    out = [r[0] for r in df.select(canonical_text(F.col("x"), T.DoubleType())).collect()]
    assert out == ["3", "2.5", None, "-4", "0.1"]


def test_guarded_number(spark):
    df = one_col(spark, ["15.5", "15:32", "7", None, "-3", "1.2.3"], T.StringType())
    rows = df.select(guarded_number(F.col("x")), guarded_number(F.col("x"), 0.0)).collect()
    assert [r[0] for r in rows] == [15.5, None, 7.0, None, None, None]
    assert [r[1] for r in rows] == [15.5, 0.0, 7.0, 0.0, 0.0, 0.0]


# Ordinal labels the reference produces.
ORDINALS = {1: "1st", 2: "2nd", 3: "3rd", 4: "4th", 11: "11th", 12: "12th", 13: "13th",
            21: "21st", 22: "22nd", 23: "23rd", 101: "101st", 111: "111th", 112: "112th",
            113: "113th"}


def test_ordinal_label(spark):
    df = one_col(spark, list(ORDINALS) + [None], T.IntegerType())
    out = [r[0] for r in df.select(ordinal_label(F.col("x"))).collect()]
    assert out == list(ORDINALS.values()) + [None]


def test_flag_and_date(spark):
    df = spark.createDataFrame([(1, "2020-01-02"), (0, ""), (None, None)], "f int, d string")
    rows = df.select(flag_bool(F.col("f")), guarded_date(F.col("d"))).collect()
    assert [r[0] for r in rows] == [True, False, None]
    assert [r[1] for r in rows] == [dt.date(2020, 1, 2), None, None]


def test_dotted_and_missing(spark):
    df = spark.createDataFrame([(1, "a")], "`a.default` int, `b.x` string")
    out = with_missing_columns(rename_columns(df, {"a.default": "a"}), {"ties": "double"})
    assert out.columns == ["a", "b.x", "ties"]
    assert out.first()["ties"] is None
    # an existing column is not replaced
    assert with_missing_columns(out, {"a": "string"}).schema["a"].dataType == T.IntegerType()


def test_row_hash_matches_python_md5(spark):
    df = spark.createDataFrame([(1, None, "x", 3.0), (None, 2.5, None, None)],
                               "a bigint, b double, c string, d double")
    got = [r[0] for r in df.select(row_hash(df.schema, ["a", "b", "c", "d"])).collect()]

    def md5(parts):
        return hashlib.md5("|".join(parts).encode()).hexdigest()
    assert got == [md5(["1", "", "x", "3"]), md5(["", "2.5", "", ""])]
    # as_double: an int and its double twin hash alike
    twin = spark.createDataFrame([(5, 5.0)], "i bigint, d double")
    h1 = twin.select(row_hash(twin.schema, ["i"], as_double=True)).first()[0]
    h2 = twin.select(row_hash(twin.schema, ["d"], as_double=True)).first()[0]
    assert h1 == h2


def test_rounded_text(spark):
    from tidemark.functions.casts import rounded_text
    df = one_col(spark, [1.0005, 0.9, None, 2.0], T.DoubleType())
    out = [r[0] for r in df.select(rounded_text(F.col("x"), 3)).collect()]
    assert out == ["1.001", "0.900", None, "2.000"]


def _written(x: float) -> str:
    """A double as the reference database prints it, from Python's digits."""
    import math
    if x != x:
        return "NaN"
    sign = "-" if math.copysign(1, x) < 0 else ""
    if math.isinf(x) or x == 0:
        return sign + ("0" if x == 0 else "Infinity")
    mantissa, _, e = repr(abs(x)).partition("e")
    whole, _, part = mantissa.partition(".")
    digits = whole + part
    exponent = int(e or 0) + len(whole) - 1 - (len(digits) - len(digits.lstrip("0")))
    digits = digits.strip("0")
    if exponent < -4 or exponent >= 15:
        return (sign + digits[0] + ("." + digits[1:] if digits[1:] else "")
                + f"e{'-' if exponent < 0 else '+'}{abs(exponent):02d}")
    if exponent < 0:
        return sign + "0." + "0" * (-exponent - 1) + digits
    digits = digits.ljust(exponent + 1, "0")
    return sign + digits[:exponent + 1] + ("." + digits[exponent + 1:] if digits[exponent + 1:] else "")


def test_double_text(spark):
    import random
    from tidemark.functions.casts import double_text
    rng = random.Random(8)
    xs = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e15, 1e-5, 1e-4, 5e-4, 1e-3, 1e16, 1e7,
          1e100, 1e15 + 0.5, 999999999999999.9, 2.0 ** 53, 2.0 ** 53 - 1, -2.5e-7, 0.1, 1 / 3]
    # (the runtime's digits are the shortest from 1e-5 up to 1e16)
    xs += [rng.uniform(-1, 1) * 10 ** rng.randint(-4, 16) for _ in range(6000)]
    xs += [round(rng.uniform(-1, 1) * 10 ** rng.randint(-3, 9), rng.randint(0, 6)) for _ in range(6000)]
    xs = xs[:20] + [x for x in xs[20:] if x == 0 or abs(x) >= 1e-5]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select(
        "i", double_text(F.col("x")).alias("t")).collect()
    assert [(xs[r.i], r.t) for r in rows if r.t != _written(xs[r.i])] == []
