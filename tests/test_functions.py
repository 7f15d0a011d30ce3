from __future__ import annotations

import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlens.functions import keys, measures, pricing, temporal, text


def values(spark, cells, kind, *exprs):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i INT, c {kind}")
    rows = df.select("i", *[e.alias(f"e{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [r[1] if len(exprs) == 1 else tuple(r[1:]) for r in rows]


def C():
    return F.col("c")


def test_whole_rating_rounds_halves_to_even(spark):
    got = values(spark, ["0.5", "1.5", "2.5", "4.5", "4.0", "x", None], "STRING", measures.whole_rating(C()))
    assert got == [0, 2, 2, 4, 4, None, None]


def test_normalize_epoch(spark):
    cells = [None, 32503680000, 32503680001, 1617000000123, 0]
    got = values(spark, cells, "BIGINT", temporal.normalize_epoch(C()).cast("timestamp_ntz"))
    assert got == [
        None, datetime(3000, 1, 1), datetime(1971, 1, 12, 4, 48), datetime(2021, 3, 29, 6, 40),
        datetime(1970, 1, 1),
    ]


def test_iso_utc(spark):
    cells = [1617000000123, 1617000000000]
    got = values(spark, cells, "BIGINT", temporal.iso_utc(temporal.from_millis(C())))
    assert got == ["2021-03-29T06:40:00.123000+00:00", "2021-03-29T06:40:00+00:00"]


def test_clean_price(spark):
    cells = [None, "", "  ", "$1,234.50", "12.345", "1-2", "-", "-3.10", "from 5.00"]
    got = values(spark, cells, "STRING", pricing.clean_price(C()))
    d = Decimal
    assert got == [None, None, None, d("1234.50"), d("12.35"), None, None, d("-3.10"), d("5.00")]


def test_price_band_borders(spark):
    cells = ["24.99", "25", "74.99", "75", "150", "299.99", "300", None, "-1"]
    band = pricing.price_band(C().cast("decimal(12,2)"))
    got = values(spark, cells, "STRING", band, pricing.band_position(band))
    names = ["0_25", "25_75", "25_75", "75_150", "150_300", "150_300", "300_plus", "unknown", "0_25"]
    assert [b for b, _ in got] == names
    assert [p for _, p in got] == [1, 2, 2, 3, 4, 4, 5, 6, 1]


def test_strip_matches_python(spark):
    cells = [" \t a \n ", " x　", "\x1cy\x1f", "a b", "", " ", "​z​", None]
    got = values(spark, cells, "STRING", text.strip(C()), text.is_empty(C()))
    assert [s for s, _ in got] == [None if c is None else c.strip() for c in cells]
    assert [e for _, e in got] == [c is None or c.strip() == "" for c in cells]
    assert values(spark, [" \t a \n "], "STRING", F.length(F.trim(C()))) == [5]


def test_whitespace_list_is_what_python_strips():
    every = {c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).strip() == ""}
    assert set(text.WHITESPACE_CODE_POINTS) == every


def test_safe_int(spark):
    cells = ["4.7", "-4.7", " 3 ", "nan", "inf", "", "5d", "1e2", ".5", "5.", "x", None]
    got = values(spark, cells, "STRING", text.safe_int(C()), text.safe_int_or(C(), 7))
    assert [g for g, _ in got] == [4, -4, 3, None, None, None, None, 100, 0, 5, None, None]
    assert got[3][1] == 7 and got[0][1] == 4


def test_flags_and_defaults(spark):
    cells = ["1", " TRUE ", "Yes\t", "y", "no", "", None, "2"]
    assert values(spark, cells, "STRING", text.verified_from_text(C())) == [True] * 4 + [False] * 4
    flags = values(spark, [True, False, None], "BOOLEAN", text.verified_or_false(C()),
                   text.verified_as_number(C()))
    assert flags == [(True, 1.0), (False, 0.0), (False, 0.0)]
    assert values(spark, [None, -3, 4], "INT", text.clamp_votes(C())) == [0, 0, 4]
    names = values(spark, [None, "  ", " a ", ""], "STRING", text.category_or_unknown(C()))
    assert names == ["unknown", "unknown", "a", "unknown"]


def test_sha256_key_keeps_missing_parts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x STRING, y STRING")
    got = [r[0] for r in df.select(keys.sha256_key(F.col("x"), F.col("y"))).collect()]
    assert got == [hashlib.sha256(t).hexdigest() for t in (b"a|", b"|a")]


def test_key_fraction(spark):
    assert values(spark, ["a|b"], "STRING", keys.key_fraction(C(), 34)) == [
        pytest.approx(0.587057305270163, abs=1e-15)
    ]


def test_share_rounds_twice(spark):
    # 0.17145 to five digits and then up to 0.1715; one rounding would give 0.1714.
    df = spark.createDataFrame([(171446, 1000000), (1, 3), (0, 5)], "h BIGINT, n BIGINT")
    got = [r[0] for r in df.select(measures.share(F.col("h"), F.col("n"))).collect()]
    assert got == [0.1715, 0.3333, 0.0]
    sql = "SELECT CAST(ROUND(AVG(CASE WHEN id < 171446 THEN 1.0 ELSE 0.0 END), 4) AS DOUBLE) FROM range(1000000)"
    assert spark.sql(sql).first()[0] == 0.1715


def test_a_rating_that_is_no_number_is_null(spark):
    from starlens.functions.measures import whole_rating

    rows = spark.createDataFrame([("NaN",), ("4.5",), ("x",), ("1e300",), (None,)], "r string")
    assert [r[0] for r in rows.select(whole_rating(F.col("r"))).collect()] == [None, 4, None, None, None]


def test_confusion_counts_every_row(spark):
    from starlens.operators.evaluation import confusion

    rows = spark.createDataFrame([(0.0, 1.0), (6.0, 6.0), (1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    found = {(r["actual"], r["predicted"]): r["count"] for r in confusion(rows).collect()}
    assert sum(found.values()) == 4 and found[0.0, 1.0] == 1 and found[1.0, 1.0] == 2 and found[2.0, 3.0] == 0


def test_whole_numbers_in_any_spelling(spark):
    cells = ["3", "3.0", "1617000000123.0", "3.5", "x", None, "9007199254740993", "NaN"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i INT, c STRING")
    got = df.select("i", measures.whole_number(F.col("c")).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in got] == [3, 3, 1617000000123, None, None, None, 9007199254740993, None]
