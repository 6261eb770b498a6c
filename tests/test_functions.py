import datetime as dt
import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import calendar, codes, json_urls, numbers, reasons


def column(spark, expr, **values):
    df = spark.range(1).select(*[v.alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(expr.alias("v")).first().v


def day(text):
    return dt.date.fromisoformat(text)


@pytest.mark.parametrize("date", ["2019-12-30", "2021-01-03", "2024-01-01", "2026-12-31", "2020-02-29"])
def test_weeks(spark, date):
    d = day(date)
    first = d - dt.timedelta(d.weekday())
    c = calendar.as_date(date)
    assert column(spark, calendar.week_anchor(c)) == first
    assert column(spark, calendar.week_anchor(c, "sunday")) == first + dt.timedelta(6)
    assert column(spark, calendar.week_text(c)) == f"{d.isocalendar().week:02d}"
    assert column(spark, calendar.year_text(c)) == str(d.year)
    assert column(spark, calendar.day_parity(c)) == (1 if d.day % 2 else 2)
    assert column(spark, calendar.twelve_weeks_before(date)) == first - dt.timedelta(77)


def test_unknown_anchor():
    with pytest.raises(ValueError):
        calendar.week_anchor(F.lit(1), "friday")


def loop_trial(start, end, today):
    target = end if end <= today else today - dt.timedelta(1)
    return [start] + [d for d in (start + dt.timedelta(n) for n in range(1, 100)) if d < target]


@pytest.mark.parametrize(
    "start, end, today",
    [
        ("2024-01-01", "2024-01-05", "2024-01-31"),
        ("2024-01-01", "2024-01-31", "2024-01-31"),
        ("2024-01-01", "2024-02-20", "2024-01-31"),
        ("2024-01-30", "2024-02-20", "2024-01-31"),
        ("2024-01-31", "2024-02-20", "2024-01-31"),
        ("2024-03-01", "2024-02-20", "2024-01-31"),
    ],
)
def test_trial_series(spark, start, end, today):
    assert column(spark, calendar.trial_series(start, end, today)) == loop_trial(day(start), day(end), day(today))


def test_other_series(spark):
    back = column(spark, calendar.series_back("2024-03-01"))
    assert (len(back), back[0], back[-1]) == (28, day("2024-02-03"), day("2024-03-01"))
    assert column(spark, calendar.series_until_yesterday("2024-03-01", "2024-03-04"))[-1] == day("2024-03-03")
    assert column(spark, calendar.series_until_yesterday("2024-03-01", "2024-02-04")) == [day("2024-03-01")]


def loop_reason(enrolled, cause, suggest, book, delivered):
    nan = float("nan")
    s, b, d = (nan if v is None else v for v in (suggest, book, delivered))
    if cause == "退货":
        return 4
    if enrolled:
        if s == 0 or math.isnan(s) or s <= d:
            return 1
        if s > b and d >= b:
            return 2
        return 3 if b >= s else 5
    return 2 if b == 0 or math.isnan(b) or b <= d else 3


def test_reasons_on_every_combination(spark):
    values = [None, 0.0, 1.0, 2.0, 3.0]
    rows = [
        (e, c, s, b, d)
        for e, c in itertools.product([True, False, None], ["退货", None, "x"])
        for s, b, d in itertools.product(values, repeat=3)
    ]
    df = spark.createDataFrame(
        rows, "enrolled boolean, cause string, cm_suggest double, store_book double, inv_delivery double"
    )
    got = df.select("*", reasons.lost_reason(F.col("enrolled")).alias("reason")).collect()
    assert all(r.reason == loop_reason(*r[:5]) for r in got)
    assert {r.reason for r in got} == {1, 2, 3, 4, 5}


def test_codes(spark):
    assert column(spark, codes.source_id(F.lit(43))) == "43YYYYYYYYYYYYY" == codes.source_id_text(43)
    assert column(spark, codes.source_id(F.lit(3201))) == "3201YYYYYYYYYYY"
    assert column(spark, codes.tenant_of(F.lit("3201YYYYYYYYYYY"))) == "3201"
    assert [column(spark, codes.cycle_code(F.lit(c))) for c in ("单日配", "双日配", "周配", None)] == [1, 2, 3, 3]
    odd, even = calendar.as_date("2024-01-31"), calendar.as_date("2024-02-02")
    table = {(c, d): column(spark, codes.can_order(F.lit(c).cast("int"), d_col)) for c in (1, 2, 3, None) for d, d_col in (("odd", odd), ("even", even))}
    assert [k for k, v in table.items() if v == 1] == [(1, "odd"), (2, "even"), (3, "odd"), (3, "even")]


def test_numbers(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, n int")
    assert [tuple(r) for r in numbers.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]
    assert column(spark, numbers.per_day(F.lit(5), F.lit(0))) == 0.0
    assert column(spark, numbers.ratio(F.lit(5), F.lit(0))) is None


DOCUMENTS = [
    {},
    {"fm_res": []},
    {"fm_res": [{"result": {}}]},
    {"fm_res": [{"result": {"metric_url": "m1", "trainfit_urls": [{"url": "f1"}, {}], "plot_urls": []}}]},
    {"fm_res": [{"result": {"trainfit_urls": [{"url": "f2"}]}}, {"result": {"metric_url": "m2", "plot_urls": [{"url": "p1"}]}}]},
]


def test_json_urls(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCUMENTS)], "i int, d string").orderBy("i")
    d = F.col("d")
    rows = df.select(json_urls.metric_urls(d), json_urls.fit_urls(d), json_urls.plot_urls(d)).collect()
    assert [list(map(list, r)) for r in rows] == [
        [[], [], []],
        [[], [], []],
        [[], [], []],
        [["m1"], ["f1"], []],
        [["m2"], ["f2"], ["p1"]],
    ]
