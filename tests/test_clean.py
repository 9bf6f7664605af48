"""Cell cleaning, case by case."""

from datetime import date
from decimal import Decimal

import pytest

from dealmill.functions import normalize as N
from dealmill.schemas import PAYMENT_TYPES


def cleaned(spark, kind, cells, *names):
    """The named result columns for each cell, in order."""
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    out = N.clean(df, {"c": kind}).orderBy("i").select(*(f"c__{n}" for n in names))
    return [tuple(r) if len(names) > 1 else r[0] for r in out.collect()]


def instants(spark, cells):
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    out = N.clean(df, {"c": N.TIMESTAMP}).orderBy("i").selectExpr("cast(c__v as string)", "c__nonstandard")
    return [tuple(r) for r in out.collect()]


def test_channels(spark):
    cells = ["Avito", "AVITO", "avito", " avito ", "Авито", "АВИТО", "Website", "Сайт", "vk_ads", "", None, " \t"]
    assert cleaned(spark, N.CHANNEL, cells, "v", "unknown", "rewritten", "id") == [
        ("avito", False, True, 1), ("avito", False, True, 1), ("avito", False, False, 1), ("avito", False, False, 1),
        ("avito", False, True, 1), ("avito", False, True, 1), ("website", False, True, 2), ("website", False, True, 2),
        ("vk_ads", True, False, None), (None, False, False, None), (None, False, False, None),
        (None, False, False, None),
    ]


def test_timestamps(spark):
    assert instants(
        spark,
        [
            "2026-06-08T16:45:00+05:00", "2026-06-08T16:45:00Z", "2026-06-08T16:45:00+0500", "2026-06-03",
            "2026-6-3", "14.06.2026 09:20", "2026/06/15", "15.06.2026", " 15.06.2026\n",
        ],
    ) == [
        ("2026-06-08 11:45:00", False), ("2026-06-08 16:45:00", False), ("2026-06-08 11:45:00", False),
        ("2026-06-02 19:00:00", False), ("2026-06-02 19:00:00", False), ("2026-06-14 04:20:00", True),
        ("2026-06-14 19:00:00", True), ("2026-06-14 19:00:00", True), ("2026-06-14 19:00:00", True),
    ]


@pytest.mark.parametrize(
    "cell",
    ["не дата", "2026-02-30", "2026-06-08T16:45:00", "2026-06-08T16:45:00.5+05:00", "2026-06-08 16:45:00+05:00",
     "31.04.2026", "2026-06-08T24:00:00Z", "2026-06-08T16:60:00Z", "0000-01-01", "08.06.26", "20260608"],
)
def test_unreadable_timestamps(spark, cell):
    assert instants(spark, [cell]) == [(None, True)]


def test_blank_timestamp(spark):
    assert instants(spark, [None, "", "  "]) == [(None, False)] * 3


def test_dates_stay_as_written(spark):
    cells = ["2026-06-11", "2026-06-11T03:00:00+05:00", "2026-06-11T23:00:00-08:00", "2026/06/15", "14.06.2026 00:10",
             "2026-02-30", None]
    assert cleaned(spark, N.DATE, cells, "v", "nonstandard") == [
        (date(2026, 6, 11), False), (date(2026, 6, 11), False), (date(2026, 6, 11), False), (date(2026, 6, 15), True),
        (date(2026, 6, 14), True), (None, True), (None, False),
    ]


def test_phones(spark):
    cells = ["89170003003", "+7 917 000-10-01", "79170003003", "123", "+7 923 709-19-92 доб.5", " 8(917)0003003 ", "",
             None]
    assert cleaned(spark, N.PHONE, cells, "v", "status") == [
        ("+79170003003", "fixed"), ("+79170001001", None), ("+79170003003", "fixed"), ("123", "unrecognized"),
        ("+7 923 709-19-92 доб.5", "unrecognized"), ("+79170003003", "fixed"), (None, None), (None, None),
    ]


def test_amounts(spark):
    cells = ["21000.10", "-12000.00", "", "abc", " 5 ", "1e5", "1_000", "12.345", None]
    assert cleaned(spark, N.AMOUNT, cells, "v") == [
        Decimal("21000.1"), Decimal("-12000"), None, None, Decimal(5), Decimal(100000), Decimal(1000),
        Decimal("12.345"), None,
    ]
    assert cleaned(spark, N.DISCOUNT, ["7", "abc", None], "v") == [Decimal(7), Decimal(0), Decimal(0)]


def test_money_rounds_halves_away_from_zero(spark):
    df = N.clean(spark.createDataFrame([("2.345",), ("-2.345",)], "c string"), {"c": N.AMOUNT})
    assert [r[0] for r in df.select(N.to_money(df["c__v"])).collect()] == [Decimal("2.35"), Decimal("-2.35")]


def test_integers(spark):
    assert cleaned(spark, N.INTEGER, ["10", " -3 ", "+4", "1_0", "10.0", "x", ""], "v") == [10, -3, 4, 10, None, None, None]


def test_flags(spark):
    cells = ["true", "1", "YES", "t", "false", "0", "No", "f", "maybe", "да", "y", "", None]
    assert cleaned(spark, N.FLAG, cells, "v") == [True] * 4 + [False] * 4 + [None] * 5


def test_text_and_currency(spark):
    cells = ["0278123456", " 0278123456\t", "   　", "", None]
    assert cleaned(spark, N.TEXT, cells, "v", "blank") == [
        ("0278123456", False), ("0278123456", False), (None, True), (None, True), (None, True)
    ]
    assert cleaned(spark, N.CURRENCY, ["USD ", " ", None], "v") == ["USD", "RUB", "RUB"]


def test_codes(spark):
    cells = ["full", " full ", "Full", "refund", " ", None]
    assert cleaned(spark, PAYMENT_TYPES, cells, "v", "invalid") == [
        ("full", False), ("full", False), (None, True), (None, True), (None, False), (None, False)
    ]


def test_blanks_at_either_end_are_all_stripped(spark):
    cells = [a + "x y" + b for blank in N.WHITESPACE for a, b in [(blank, ""), ("", blank), (blank * 2, "\u0416" + blank)]]
    cells += ["!", "~", "\x7f", "\x7fa", "a\x7f", "\u0416", "a\u0416", "\u0416a", "\x1ba\x1b", "", *N.WHITESPACE]
    assert cleaned(spark, N.TEXT, cells, "v") == [c.strip(N.WHITESPACE) or None for c in cells]
    assert "substring" in N.text_or_null("c")
