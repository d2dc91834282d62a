import datetime
import zlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck import Refused
from replicheck.functions import crc_hex, row_text, text_crc, typed_hash
from replicheck.functions.times import time_value


def text_of(spark, schema, row, columns, nullable=(), **options):
    df = spark.createDataFrame([row], schema)
    return df.select(row_text(df.schema, columns, nullable, **options)).first()[0]


def test_text_of_types(spark):
    schema = "i int, l long, d decimal(10,2), b boolean, dt date, s string, ts timestamp_ntz"
    row = (
        -1,
        7,
        Decimal("1.50"),
        True,
        datetime.date(2020, 1, 2),
        "ä",
        datetime.datetime(2020, 1, 2, 3, 4, 5, 60),
    )
    names = ["i", "l", "d", "b", "dt", "s", "ts"]
    text = text_of(spark, schema, row, names)
    assert text == "-1#7#1.50#1#2020-01-02#ä#2020-01-02 03:04:05.000060#1"
    text = text_of(spark, schema, row, ["ts"], fraction_digits={"ts": 0})
    assert text == "2020-01-02 03:04:05#1"


def test_long_fractions_have_no_exponent(spark):
    for value in ("0", "0.00000000000000000001", "12.5", "-1234567.25"):
        row = (Decimal(value),)
        text = text_of(spark, "d decimal(38,20)", row, ["d"])
        assert text == f"{Decimal(value):.20f}#1"


def test_doubles_need_a_decimal(spark):
    with pytest.raises(Refused):
        text_of(spark, "x double", (1e7,), ["x"])
    text = text_of(spark, "x double", (1e7,), ["x"], decimals={"x": (18, 2)})
    assert text == "10000000.00#1"


@pytest.mark.parametrize("dtype", ["array<int>", "map<string,int>", "struct<a:int>"])
def test_nested_types_are_refused(spark, dtype):
    df = spark.createDataFrame([], f"x {dtype}")
    with pytest.raises(Refused):
        row_text(df.schema, ["x"], [])


def test_nulls_are_left_out_and_flagged(spark):
    schema = "a string, b string, c string"
    assert text_of(spark, schema, ("x", None, "z"), ["a", "b", "c"], ["b", "c"]) == "x#z#10"
    assert text_of(spark, schema, ("x", "z", None), ["a", "b", "c"], ["b", "c"]) == "x#z#01"


def test_separator_is_not_escaped(spark):
    one = text_of(spark, "a string, b string", ("a#b", "c"), ["a", "b"])
    assert one == text_of(spark, "a string, b string", ("a", "b#c"), ["a", "b"])


def test_crc_of_raw_bytes(spark):
    raw = bytes(range(256))
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    text = row_text(df.schema, ["b"], [])
    assert df.select(text_crc(text)).first()[0] == zlib.crc32(raw + b"#1")


def test_typed_hash_tells_apart_what_the_text_does_not(spark):
    df = spark.createDataFrame([("a#b", "c"), ("a", "b#c"), (None, "c")], "a string, b string")
    hashes = [r[0] for r in df.select(typed_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == 3


def test_hex_of_folds(spark):
    values = [(0, "0"), (None, "0"), (255, "ff"), (0xFFFFFFFF, "ffffffff"), (-1, "f" * 16)]
    df = spark.createDataFrame(values, "x long, y string")
    assert all(r[0] == r[1] for r in df.select(crc_hex(F.col("x")), "y").collect())


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2017-01-01 23:00:00", 1483311600),
        ("2017-01-01", None),
        ("2017-13-01 00:00:00", None),
        ("x", None),
        (None, None),
    ],
)
def test_time_as_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(time_value("t", T.StringType(), "str")).first()[0] == expected


def test_time_as_timestamp_and_integer(spark):
    at = datetime.datetime(2017, 1, 1, 23, 0, 0)
    broken = at.replace(microsecond=5)
    df = spark.createDataFrame([(at, 5), (broken, None)], "t timestamp_ntz, n long")
    rows = df.select(
        time_value("t", T.TimestampNTZType(), "str"), time_value("n", T.LongType(), "int")
    ).collect()
    assert [tuple(r) for r in rows] == [(1483311600, 5), (None, None)]
    texts = spark.createDataFrame([("1526736502",), ("x",)], "n string")
    found = texts.select(time_value("n", T.StringType(), "int")).collect()
    assert [r[0] for r in found] == [1526736502, None]


def test_time_follows_the_session_zone(spark):
    df = spark.createDataFrame([("2017-01-01 23:00:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert df.select(time_value("t", T.StringType(), "str")).first()[0] == 1483311600 - 8 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
