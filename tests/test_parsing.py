import datetime
import math
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import parsing, wire


def parsed(spark, function, cells):
    df = spark.createDataFrame([(n, c) for n, c in enumerate(cells)], "n int, cell string")
    return [r[0] for r in df.orderBy("n").select(function(F.col("cell"))).collect()]


def check(spark, function, expected):
    assert parsed(spark, function, list(expected)) == list(expected.values())


def test_to_int(spark):
    check(spark, parsing.to_int, {
        "42": 42, "  7  ": 7, "-3": -3, "42.0": 42, "42.9": 42, "-3.9": -3, "1e2": 100, "1_000": 1000, ".5": 0,
        "5.": 5, "\t8\n": 8, None: None, "": None, "   ": None, "words": None, "12d": None, "inf": None, "-inf": None,
        "Infinity": None, "nan": None, "1__0": None, "99999999999": None,
    })


def test_to_whole(spark):
    check(spark, parsing.to_whole, {"42": 42, " -7 ": -7, "42.0": None, "": None, "x": None, "1_0": 10})


def test_to_float(spark):
    check(spark, parsing.to_float, {
        "4.5": 4.5, "-2": -2.0, " 3.14 ": 3.14, "": None, None: None, "nope": None,
        "inf": math.inf, "-Infinity": -math.inf, "1f": None,
    })
    assert math.isnan(parsed(spark, parsing.to_float, ["NaN"])[0])


def test_to_decimal_is_null_when_it_does_not_fit(spark):
    got = parsed(spark, lambda c: parsing.to_decimal(c, "decimal(3,1)"), ["7.25", "100", "inf"])
    assert [None if g is None else float(g) for g in got] == [7.3, None, None]


def test_to_bool(spark):
    check(spark, parsing.to_bool, {
        "true": True, "TRUE": True, " tRuE ": True, "false": False, "": False, "0": False, "1": False, "yes": False, None: False,
    })


def test_dates(spark):
    day = datetime.date(2022, 7, 5)
    check(spark, parsing.long_date, {"July 5, 2022": day, " july 05, 2022 ": day, "2022": None, "Juli 5, 2022": None, None: None})
    check(spark, parsing.iso_date, {"2022-07-05": day, "2022-7-5": day, "2022-13-01": None, "soon": None, "": None})


@pytest.mark.parametrize("cell, expected", [
    ("['drama', 'crime']", ["drama", "crime"]),
    ('["drama", "crime"]', ["drama", "crime"]),
    ("('drama', 'crime')", ["drama", "crime"]),
    ("('drama', 'crime',)", ["drama", "crime"]),
    ("[1, 2, 3]", ["1", "2", "3"]),
    ("['drama', '', '  ']", ["drama"]),
    ("[\"it's\", 'b']", ["it's", "b"]),
    ("[]", []),
    ("", []),
    (None, []),
    ("   ", []),
    ("drama, crime", ["drama", "crime"]),
    ("[drama], [crime]", ["drama", "crime"]),
    ("'hello'", ["hello"]),
    ("['a', 'b'", ["a", "b"]),
])
def test_parse_list(spark, cell, expected):
    assert parsed(spark, parsing.parse_list, [cell]) == [expected]


def test_wire_values(spark):
    """Unscaled decimals as producers may write them: minimal, sign-extended, empty, too large for the type."""
    cases = [
        (b"\x00\xc8", Decimal("20.0")), (b"\x54", Decimal("8.4")), (b"\xff", Decimal("-0.1")), (b"\xfc\x18", None),
        (b"\xff\xff\xff\xff\xff\xff\xff\xff\xff\xb0", Decimal("-8.0")), (b"\x00" * 12 + b"\x07", Decimal("0.7")), (b"", Decimal("0.0")), (None, None),
    ]
    kind = T.DecimalType(3, 1)
    rows = spark.createDataFrame([(n, raw) for n, (raw, _) in enumerate(cases)], "n int, raw binary")
    found = rows.select("n", wire.decode(F.col("raw"), kind).alias("v")).orderBy("n").collect()
    assert [r.v for r in found] == [v for _, v in cases]


def test_rows_survive_the_wire(spark):
    row = T.StructType([T.StructField("d", T.DecimalType(6, 2)), T.StructField("day", T.DateType()), T.StructField("at", T.TimestampType()), T.StructField("s", T.StringType())])
    at = datetime.datetime(1969, 12, 31, 23, 59, 59, 123000)
    values = [(Decimal(n).scaleb(-2), date(1965, 1, 1) + timedelta(days=n), at + timedelta(days=n), str(n)) for n in (-99999, -256, -1, 0, 1, 127, 128, 255, 256, 999999)]
    frame = spark.createDataFrame([*values, (None, None, None, None)], row)
    for times in (wire.ISO, wire.MILLIS):
        text = F.to_json(wire.encode_row(row, times))
        image = F.from_json(text, wire.wire_schema(row, times))
        back = frame.select(*row.names, image.alias("image")).select(*row.names, wire.decode_row(F.col("image"), row, times).alias("back"))
        assert all(tuple(r.back) == tuple(r)[:4] for r in back.collect())
    with pytest.raises(ValueError):
        wire.wire_schema(T.StructType([T.StructField("d", T.DecimalType(30, 2))]))
