from datetime import datetime, timezone
from email.utils import format_datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from chronolith.functions import time

MOMENTS = [0, 1, 999_999, 1_712_412_345_678_901, 1_710_064_800_000_000, 1_710_068_400_000_000, 1_730_620_800_123_000, 1_730_624_400_000_000, -1_500_000, 1_775_458_800_000_000]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(m,) for m in MOMENTS], "us long").coalesce(1)


def of(us):
    return datetime.fromtimestamp(us // 1_000_000, timezone.utc).replace(microsecond=us % 1_000_000)


def column(rows, c):
    return [r[0] for r in rows.select(c).collect()]


def test_iso_forms_do_not_depend_on_the_session_zone(rows):
    assert column(rows, time.iso_millis(F.col("us"))) == [of(m).isoformat(timespec="milliseconds").replace("+00:00", "Z") for m in MOMENTS]
    assert column(rows, time.iso_short(F.col("us"))) == [of(m).isoformat().replace("+00:00", "Z") for m in MOMENTS]
    local = [of(m).astimezone(ZoneInfo("America/Los_Angeles")) for m in MOMENTS]
    assert column(rows, time.iso_local(F.col("us"))) == [t.isoformat(timespec="milliseconds") for t in local]
    assert column(rows, time.local_day(F.col("us"))) == [t.date().isoformat() for t in local]
    assert column(rows, time.offset_text(F.col("us"), separator="")) == [t.strftime("%z") for t in local]


def test_micros_invert_wall(rows):
    assert column(rows, time.micros(time.wall(F.col("us")))) == MOMENTS


@pytest.mark.parametrize(
    ("text", "seconds"),
    [("2026-04-07T10:00:00Z", 1775556000), ("2026-04-07T10:00:00.25Z", 1775556000.25), ("2026-04-07T03:00:00-07:00", 1775556000), ("2026-04-07T10:00:00", 1775556000), ("2026-04-07", 1775520000), ("16:31", None), ("", None), ("soon", None), ("2026-13-01T00:00:00Z", None)],
)
def test_event_parser(spark, text, seconds):
    got = spark.createDataFrame([(text,)], "t string").select(time.parse_event(F.lit(None).cast("double"), F.col("t"))).first()[0]
    assert got == (None if seconds is None else int(seconds * 1_000_000))


def test_naive_text_takes_the_given_zone(spark):
    got = spark.createDataFrame([("2026-04-07T03:00:00",)], "t string").select(time.parse_event(F.lit(None).cast("double"), F.col("t"), time.LOCAL_ZONE)).first()[0]
    assert got == 1775556000000000


def test_window_parsers_take_the_end_and_the_start(spark):
    df = spark.createDataFrame([("2026-04-07T10:00:00Z/2026-04-07T10:15:00Z",), ("2026-04-07T10:00:00Z-2026-04-07T10:15:00Z",)], "t string")
    none = F.lit(None).cast("double")
    assert column(df, time.parse_window_end(none, F.col("t"))) == [1775556900000000] * 2
    assert column(df, time.parse_first(F.concat(F.lit("from "), F.col("t")))) == [1775556000000000] * 2


def test_mail_dates(spark):
    t = of(1_712_412_345_000_000)
    cases = {format_datetime(t): "2024-04-06T14:05:45Z", "Sat, 6 Apr 2024 07:05:45 -0700 (PDT)": "2024-04-06T14:05:45Z", "6 Apr 2024 14:05:45 GMT": "2024-04-06T14:05:45Z", "6 Apr 2024 14:05 +0000": "2024-04-06T14:05:00Z", "yesterday": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").coalesce(1)
    assert column(df, time.parse_mail_date(F.col("t"))) == list(cases.values())


def test_labels(spark):
    df = spark.createDataFrame([(0.4,), (59.0,), (61.0,), (3723.9,)], "s double").coalesce(1)
    assert column(df, time.duration_label(F.col("s"))) == ["0s", "59s", "1m01s", "1h02m03s"]
    df = spark.createDataFrame([(1775513100000000,), (None,)], "us long").coalesce(1)
    assert column(df, time.label(F.col("us"))) == ["Mon Apr 6, 3:05 PM", "Missing timestamp"]
