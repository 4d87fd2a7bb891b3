from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.tables import table
from millrace.functions.timekeys import format_hour, parse_hour
from millrace.model import TRACKER_SCHEMA, TableJob
from millrace.operators.cdc import (
    HourWindow,
    KeyRange,
    Mark,
    changed_rows,
    hour_window,
    plan_window,
    watermark_of,
    watermark_row,
    watermarks,
)

HOUR = datetime(2024, 1, 2, 5)


def ids(df):
    return sorted(row.id for row in df.collect())


def test_hour_bounds(spark):
    stamps = ["2024-01-01 23:59:59.999", "2024-01-02 00:00:00", "2024-01-02 04:59:59.999", "2024-01-02 05:00:00"]
    for kind in ("timestamp", "timestamp_ntz"):
        text = spark.createDataFrame(list(enumerate(stamps)), "id int, ts string")
        df = text.selectExpr("id", f"CAST(ts AS {kind}) AS ts")
        assert ids(changed_rows(df, hour_window(["ts"], "2024010200", datetime(2024, 1, 2, 5, 59)))) == [1, 2]
        assert ids(changed_rows(df, hour_window(["ts"], None, HOUR))) == [0, 1, 2]


def test_date_column_counts_as_midnight(spark):
    days = [(0, date(2024, 1, 1)), (1, date(2024, 1, 2)), (2, date(2024, 1, 3)), (3, None)]
    df = spark.createDataFrame(days, "id int, day date")
    window = HourWindow(("day",), datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 12))
    assert ids(changed_rows(df, window)) == [1]
    assert ids(changed_rows(df, HourWindow(("day",), None, datetime(2024, 1, 2)))) == [0]


def test_either_column_and_nulls(spark):
    early, inside, late = "2023-12-31 00:00:00", "2024-01-02 01:00:00", "2024-02-01 00:00:00"
    rows = [(0, inside, None), (1, None, inside), (2, early, late), (3, None, None), (4, inside, early)]
    df = spark.createDataFrame(rows, "id int, m string, c string").selectExpr(
        "id", "CAST(m AS timestamp) AS modified", "CAST(c AS timestamp) AS created"
    )
    window = hour_window(["modified", "created"], "2024010200", HOUR)
    assert ids(changed_rows(df, window)) == [0, 1, 4]
    assert ids(changed_rows(df, hour_window(["modified", None], "2024010200", HOUR))) == [0, 4]


def test_window_needs_a_column():
    with pytest.raises(ValueError):
        hour_window([None, None], None, HOUR)


def test_key_range(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate([1, 5, 6, 9, 10, None])], "id int, k bigint")
    assert ids(changed_rows(df, KeyRange("k", 5, 9))) == [2, 3]
    assert ids(changed_rows(df, KeyRange("k", None, 9))) == [0, 1, 2, 3]
    assert ids(changed_rows(df, KeyRange("k", 9, 9))) == []


def test_windows_reach_the_scan(spark, sf_dir):
    df = changed_rows(table(spark, sf_dir, "events"), hour_window(["ts"], "2024010106", HOUR))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T06:00)" in plan and "LessThan(ts,2024-01-02T05:00)" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 24 * 31), min_size=1, max_size=4, unique=True))
def test_consecutive_windows_tile(spark, sf_dir, hours):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    first = datetime(2024, 1, 1)
    ends = [datetime.fromtimestamp(first.timestamp() + 3600 * h) for h in sorted(hours)] + [datetime(2024, 3, 1)]
    watermark, seen = None, []
    for end in ends:
        window = hour_window(["ts"], watermark, end)
        seen += [row.event_id for row in changed_rows(events, window).collect()]
        watermark = window.watermark["ts_hour"]
    assert sorted(seen) == list(range(events.count()))


def test_hour_keys():
    assert parse_hour("2024123112") == datetime(2024, 12, 31, 12)
    assert parse_hour("20250101") == datetime(2025, 1, 1)
    assert format_hour(HOUR) == "2024010205"


def job(**given):
    return TableJob("J1", "s", "t", "x", "t", load_type="incremental", **given)


def tracker(spark, *rows):
    return spark.createDataFrame([(*row, None, None) for row in rows], TRACKER_SCHEMA)


def test_plan_without_rule(spark):
    none = tracker(spark)
    assert plan_window(job(), none, HOUR, None) is None
    assert plan_window(job(cdc_type="TIMESTAMP"), none, HOUR, None) is None
    assert plan_window(job(cdc_type="APPEND_KEY"), none, HOUR, None) is None
    full = TableJob("J1", "s", "t", "x", "t", cdc_type="TIMESTAMP", cdc_modified_date_column="m")
    assert plan_window(full, none, HOUR, None) is None


def test_first_key_load_reads_everything_up_to_the_maximum(spark):
    keyed = job(cdc_type="append_key", cdc_append_key_column="ID")
    assert plan_window(keyed, tracker(spark), HOUR, lambda: 123) == KeyRange("ID", None, 123)
    known = tracker(spark, ("J1", "t", None, Decimal(999)), ("J1", "t", None, Decimal(1000)), ("J2", "t", None, Decimal(5000)))
    assert plan_window(keyed, known, HOUR, lambda: 2000) == KeyRange("ID", 1000, 2000)
    assert plan_window(keyed, known, HOUR, lambda: None) is None


def test_timestamp_plan_uses_the_latest_watermark(spark):
    stamped = job(cdc_type="TIMESTAMP", cdc_modified_date_column="M", cdc_created_date_column="C")
    known = tracker(spark, ("J1", "t", "2023123112", None), ("J1", "t", "2024010103", None),
                    ("J1", "u", "2024010104", None))
    window = plan_window(stamped, known, datetime(2024, 1, 2, 5, 30), None)
    assert window == HourWindow(("M", "C"), datetime(2024, 1, 1, 3), HOUR)
    after = known.union(watermark_row(known, stamped, window))
    assert watermark_of(after, stamped) == Mark("2024010205")


STAMPED = job(cdc_type="TIMESTAMP", cdc_modified_date_column="m")
KEYED = job(cdc_type="APPEND_KEY", cdc_append_key_column="k")


def untyped(spark, kind, values):
    return spark.createDataFrame([("J1", "t", v) for v in values], f"job_id string, source_table string, updated_at {kind}")


@pytest.mark.parametrize(
    ("kind", "values", "hour"),
    [
        ("string", ["2024123112", "20250101", None], datetime(2025, 1, 1)),
        ("string", ["20241231120500"], datetime(2024, 12, 31, 12)),
        ("string", ["2024-01-02 06:00:00", "2024-01-02T05:59:59.5", "2024-01-01"], datetime(2024, 1, 2, 6)),
        ("bigint", [2024010106, 20240102], datetime(2024, 1, 2)),
        ("timestamp", [datetime(2024, 12, 31, 12, 30)], datetime(2024, 12, 31, 12)),
        ("string", [None], None),
    ],
)
def test_untyped_hour_marks(spark, kind, values, hour):
    window = plan_window(STAMPED, untyped(spark, kind, values), datetime(2025, 2, 1), None)
    assert window.lo == hour


@pytest.mark.parametrize("value", ["n/a", "2024", "2024013", "2024013125", "20241301", "2024-13-01 00:00:00", ""])
def test_unknown_hour_marks_are_an_error(spark, value):
    with pytest.raises(ValueError, match="name no hour"):
        plan_window(STAMPED, untyped(spark, "string", [value, "2024010106"]), HOUR, None)


def test_untyped_key_marks(spark):
    window = plan_window(KEYED, untyped(spark, "string", ["999", "1000.25", "7"]), HOUR, lambda: Decimal("2000.50"))
    assert (window.lo, window.hi) == (Decimal("1000.25"), Decimal("2000.50"))
    assert plan_window(KEYED, untyped(spark, "decimal(20,4)", [Decimal("999")]), HOUR, lambda: 2000).lo == 999
    for value in ("n/a", "2024010206", "20240102"):  # an hour, or a key: the tracker does not say
        with pytest.raises(ValueError, match="write them to key_value"):
            plan_window(KEYED, untyped(spark, "string", [value]), HOUR, lambda: 2000)


@pytest.mark.parametrize("kind, values", [
    ("decimal(38,0)", ["9" * 38, "1" + "0" * 37, "123", "-5"]),
    ("decimal(38,16)", ["1234567890123456789012.0000000000000002", "1234567890123456789012.0000000000000001", "-0.5"]),
    ("double", ["2.5e-19", "1e300", "-1e300", "5e-324", "0.1"]),
    ("double", ["-2.5e-19", "-2.4e-19", "-1e300"]),
])
def test_keys_of_any_size_are_exact_marks(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string").selectExpr("id", f"CAST(v AS {kind}) AS k")
    keys = sorted((r.k, r.id) for r in df.collect())
    known = tracker(spark)
    for key, _ in keys:  # one run per key: each mark must be the exact lower bound of the next
        window = plan_window(KEYED, known, HOUR, lambda key=key: key)
        assert ids(changed_rows(df.where(F.col("k") <= F.lit(key)), window)) == [i for k, i in keys if k == key]
        known = known.union(watermark_row(known, KEYED, window))
    assert plan_window(KEYED, known, HOUR, lambda: keys[-1][0]).lo == Decimal(repr(keys[-1][0]) if kind == "double" else keys[-1][0])


def test_a_key_that_is_no_number_fails_before_the_extract(spark):
    for key in (float("nan"), float("inf"), Decimal("NaN")):
        with pytest.raises(ValueError):
            plan_window(KEYED, tracker(spark), HOUR, lambda key=key: key)


def test_whole_trackers_keep_other_keys_as_text(spark):
    narrow = spark.createDataFrame([("J1", "t", None, 7)], "job_id string, source_table string, ts_hour string, key_value bigint")
    rows = [watermark_row(narrow, KEYED, KeyRange("k", None, key)).first() for key in (12, 3.5, 2**63, 2**63 - 1)]
    assert [(r.key_value, r.key_text) for r in rows] == [(12, None), (None, "3.5"), (None, str(2**63)), (2**63 - 1, None)]


def test_keys_keep_their_fractions(spark):
    rows = [(0, 1.0), (1, 2.0), (2, 3.5), (3, 0.1 + 0.2), (4, None)]
    for kind in ("double", "decimal(20,17)", "float"):
        df = spark.createDataFrame(rows, "id int, v double").selectExpr("id", f"CAST(v AS {kind}) AS k")
        first = plan_window(KEYED, tracker(spark), HOUR, lambda df=df: df.agg({"k": "max"}).first()[0])
        assert ids(changed_rows(df, first)) == [0, 1, 2, 3]
        known = watermark_row(tracker(spark), KEYED, first)
        more = df.union(spark.createDataFrame([(5, 3.75)], "id int, v double").selectExpr("id", f"CAST(v AS {kind})"))
        again = plan_window(KEYED, known, HOUR, lambda more=more: more.agg({"k": "max"}).first()[0])
        assert ids(changed_rows(more, again)) == [5]
        low = plan_window(KEYED, watermark_row(tracker(spark), KEYED, KeyRange("k", None, df.agg({"k": "min"}).first()[0])),
                          HOUR, lambda df=df: df.agg({"k": "max"}).first()[0])
        assert ids(changed_rows(df, low)) == [0, 1, 2]


def test_whole_columns_with_marks_between_keys(spark):
    df = spark.createDataFrame([(i, i) for i in range(5)], "id int, k bigint")
    assert ids(changed_rows(df, KeyRange("k", Decimal("1.5"), Decimal("3.5")))) == [2, 3]


@pytest.mark.parametrize("key", [float("nan"), float("inf")])
def test_keys_that_the_tracker_cannot_hold(key):
    with pytest.raises(ValueError, match="cannot hold"):
        KeyRange("k", None, key).watermark  # noqa: B018


def test_keys_that_are_no_numbers(spark):
    with pytest.raises(ValueError, match="must be a number"):
        plan_window(KEYED, tracker(spark), HOUR, lambda: "abc")


def test_one_aggregate_by_hash(spark):
    plan = watermarks(tracker(spark, ("J1", "t", "2024010106", None)))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_window_equals_the_comparison_of_hour_keys(spark):
    """Against the text form: the hour key of either column lies in [watermark, hour of the run)."""
    rnd = random.Random(3)

    def stamp():
        if rnd.random() < 0.1:
            return None
        seconds = rnd.choice([0, 3599, 3600, rnd.randint(0, 4 * 86400)])
        return datetime(2024, 1, 1) + timedelta(seconds=seconds + rnd.choice([0, 0.5]))

    rows = [(i, stamp(), stamp()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, m timestamp, c timestamp_ntz")

    def key(ts):
        return ts.strftime("%Y%m%d%H") if ts else None

    for lo, run_ts in ((None, datetime(2024, 1, 2, 3, 4)), ("2024010100", datetime(2024, 1, 1, 1)),
                       ("2024010123", datetime(2024, 1, 3, 0, 59)), ("2024010300", datetime(2024, 1, 2))):
        hi = key(run_ts)
        expected = [
            i for i, *stamps in rows
            if any(key(ts) is not None and (lo is None or key(ts) >= lo) and key(ts) < hi for ts in stamps)
        ]
        assert ids(changed_rows(df, hour_window(["m", "c"], lo, run_ts))) == expected
