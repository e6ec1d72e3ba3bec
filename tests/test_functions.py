from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.functions import stats, text
from gaugeframe.functions.timestamps import iso_text, parse_timestamp
from gaugeframe.operators.cleaning import clean_table
from gaugeframe.session import local_frame


def values(df):
    return [row[0] for row in df.collect()]


def test_strip_takes_unicode_spaces_but_no_tabs(spark):
    df = local_frame(spark, [("  a ",), ("\ta ",), (" 　 ",), (None,)], "s string")
    assert values(df.select(text.clean_text(F.col("s")))) == ["a", "\ta", None, None]
    assert values(df.select(text.clean_lower(F.upper("s"))))[0] == "a"


def test_canonicalise(spark):
    df = local_frame(spark, [(" Texas",), ("zz",), ("",), (None,), ("ca'x",)], "s string")
    aliases = {"texas": "TX", "ca'x": 'C"A'}
    c = text.canonicalise(F.col("s"), aliases, F.upper(text.strip_spaces(F.col("s"))))
    assert values(df.select(c)) == ["TX", "ZZ", None, None, 'C"A']
    assert values(df.select(text.canonicalise(F.col("s"), {}, F.col("s")))) == [
        " Texas", "zz", None, None, "ca'x"]


def test_canonicalise_by_table_keeps_every_row_once(spark):
    df = local_frame(spark, [(1, " Texas"), (2, "zz"), (3, None)], "id int, s string")
    words = local_frame(
        spark, [("texas", "TX"), ("texas", "TX")], "alias string, canonical string")
    for limits in ({}, {"map_rows": 0}, {"map_rows": 0, "broadcast_bytes": 0}):  # map, broadcast, split
        got = text.canonicalise_by_table(df, "s", words, F.upper(F.col("s")), **limits)
        assert got.columns == ["id", "s"]
        assert sorted(tuple(r) for r in got.dropna().collect()) == [(1, "TX"), (2, "ZZ")]
        assert got.count() == 3


def reference_parse(value):
    """The documented behaviour, through the public dateutil parser."""
    from dateutil import parser

    if not value or not value.strip():
        return None
    try:
        moment = parser.parse(value.strip(), default=datetime(1, 1, 1))
    except (ValueError, OverflowError):
        return None
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment if moment.year > 1 else None


TIMES = [
    "2024-01-15 14:30:00", "01/06/2024 08:00:00", "01/06/2024 08:00 AM", "March 3 2024 16:35",
    "2024-03-05T09:15:00+00:00", "04/02/2024 13:20", "2024-01-01T09:00:00Z",
    "2024-01-02 10:00 AM", "", "1/5/2024 08:00", "Jan 7 2024 10:00", "2024-01-08 11:11:11",
    "13/01/2024 10:00", "garbage", None, "2024-01-01T09:00:00+05:30", "12/31/2023 12:05 am",
    "12/31/2023 12:05 PM", "5 March 2024", "1/5/24", "2024-02-30", "2024-13-01",
    "2024-01-01 10:00:00.123456", "2024-01-01 10:00:00.5", " 2024-01-01 10:00 ", "2024/01/15",
    "2024-01-01T23:30:00-0800", "Sept 9, 2024 7:05 pm", "2024-01-01 25:00", "2024-01-01 13:00 PM",
    "20240105", "20240105T103000", "20240105 10:30", "20240105T1030", "20240105103000",
    "2024-01-05T10", "2024-01-05 10 AM", "2024/1/5 3pm", "2024-01-05T103000", "5-Jan-24",
    "Jan 5 24", "Mon, 05 Jan 2024 10:30:00 GMT", "Fri Jan 5 2024 10:30", "Friday, January 5, 2024",
    "10:30 2024-01-05", "10:30:15.25 pm, 5 January 2024", "3pm 2024/1/5",
    "5 January 2024 at 3:15 pm", "2024-01-05 10:30:00 EST", "2024-01-05 10:30 UTC", "10:30",
    "Monday", "Mon 10:30", "12345678", "2024-01-05 10:3", "20240105 1", "2024-01-05 1:2:3",
    "December 25th, 2023", "1999-12-31T23:59:59.999999Z", "31/12/1999",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_timestamp_as_documented(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = local_frame(spark, [(t,) for t in TIMES], "s string")
        got = values(df.select(parse_timestamp(F.col("s"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dict(zip(TIMES, got)) == {t: reference_parse(t) for t in TIMES}


def test_parts_of_a_date_are_no_time(spark):
    partial = local_frame(spark, [("Jan 2024",), ("10:30",), ("5 March",), ("240105",)], "s string")
    assert values(partial.select(parse_timestamp(F.col("s")))) == [None] * 4


def test_generated_times_agree(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    shapes = ["%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M", "%B %d %Y %H:%M:%S", "%b %d, %Y %I:%M %p",
              "%d %b %Y", "%Y-%m-%dT%H:%M:%S+02:00", "%m-%d-%Y %I:%M:%S %p"]
    moments = st.datetimes(datetime(1950, 1, 1), datetime(2060, 12, 31))

    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.tuples(moments, st.sampled_from(shapes)), min_size=30, max_size=30))
    def check(pairs):
        texts = [m.strftime(s) for m, s in pairs]
        got = values(local_frame(spark, [(t,) for t in texts], "s string").select(
            parse_timestamp(F.col("s"))))
        assert got == [reference_parse(t) for t in texts]

    check()


def test_iso_text(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.5' a, timestamp_ntz'2024-01-02' b")
    assert df.select(iso_text(F.col("a")), iso_text(F.col("b"))).first() == (
        "2024-01-02T03:04:05.500000", "2024-01-02T00:00:00")


def test_ratios(spark):
    df = local_frame(spark, [(1, 3), (0, 0), (None, 2)], "a int, b int")
    assert values(df.select(stats.ratio(F.col("a"), F.col("b")))) == [1 / 3, 0.0, None]
    assert values(df.select(stats.rounded_ratio(F.col("a"), F.col("b"))))[:2] == [0.3333, 0.0]


def test_clean_tables(spark):
    raw = local_frame(
        spark, [(" u1", "  A@B.c ", "o", "Teacher ", " CAX ", ""), ("", "", "", "", "zz", None)],
        "user_id string, email string, org_id string, role string, state string, district_id string")
    rows = [tuple(r) for r in clean_table(raw, "users", defaults.VOCABULARY).collect()]
    assert rows == [("u1", "a@b.c", "o", "teacher", "CA", None), (None, None, None, None, "ZZ", None)]
    raw = local_frame(spark, [("r", "Module ", " x ", "grades pre k to 2"), ("q", "a", "", "odd ")],
                      "resource_id string, type string, subject string, grade_band string")
    rows = [tuple(r) for r in clean_table(raw, "resources", defaults.VOCABULARY).collect()]
    assert rows == [("r", "module", "x", "PreK-2"), ("q", "a", None, "odd")]
    raw = local_frame(spark, [("d", "NYC", "new york"), ("e", " x", "texas")],
                      "district_id string, district_name string, state string")
    rows = [tuple(r) for r in clean_table(raw, "districts", defaults.VOCABULARY).collect()]
    assert rows == [("d", "NYC Public Schools", "NY"), ("e", "x", "TX")]


def test_vocabulary_frame(spark):
    rows = {tuple(r) for r in defaults.VOCABULARY.frame(spark).collect()}
    assert ("state", "cax", "CA") in rows and ("district", "nyc", "NYC Public Schools") in rows
