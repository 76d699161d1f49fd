"""Text and date expressions, value by value."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import at
from shipreport.functions import dates, text


def values(spark, rows, schema, *exprs):
    out = spark.createDataFrame(rows, schema).select(*exprs).collect()
    return [r[0] if len(r) == 1 else tuple(r) for r in out]


def test_blank_and_code_comparison(spark):
    rows = [(None,), ("",), ("   ",), ("void",), ("VOID  ",), (" VOID",)]
    a = F.col("a")
    got = values(spark, rows, "a string", text.is_blank(a), F.coalesce(text.not_blank(a), F.lit(False)),
                 text.code_eq(a, "Void "), text.code_ne(a, "VOID"), text.code_eq(a, "VOID", ignore_case=False))
    assert got == [
        (True, False, None, None, None), (True, False, False, True, False), (True, False, False, True, False),
        (False, True, True, False, False), (False, True, True, False, True), (False, True, False, True, False)]


def test_join_text_is_null_if_a_part_is(spark):
    assert values(spark, [("a", "b"), ("a", None)], "a string, b string",
                  text.join_text(F.col("a"), F.col("b"))) == ["ab", None]


def test_pieces_label(spark):
    rows = [(12, "PLT", 0, None), (12, "PLT", 3, "CTN"), (12, "PLT", None, "CTN"), (12, "PLT", 3, None),
            (12, None, 0, "CTN")]
    full = text.pieces_label(F.col("p"), F.col("u"), F.col("n"), F.col("v"))
    short = text.pieces_label(F.col("p"), F.col("u"))
    assert values(spark, rows, "p int, u string, n int, v string", full, short) == [
        ("12 PLT", "12 PLT"), ("12 PLT 3 CTN", "12 PLT"), (None, "12 PLT"), (None, "12 PLT"), (None, None)]


def test_pieces_by_unit(spark):
    assert values(spark, [(4, "plt "), (4, "CTN"), (4, None)], "p int, u string",
                  text.pieces_by_unit(F.col("p"), F.col("u"), "PLT")) == [4, None, None]


def test_left_and_right(spark):
    assert values(spark, [("SGSIN",), ("A",), ("",), (None,)], "a string",
                  text.left_chars(F.col("a"), 2), text.right_chars(F.col("a"), 3)) == [
        ("SG", "SIN"), ("A", "A"), ("", ""), (None, None)]


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_file_names_as_python_reads_them(spark, data):
    piece = st.text(st.sampled_from("aB3.pdfPDF *\t\n 　ß"), max_size=14)
    names = data.draw(st.lists(piece, min_size=200, max_size=200))
    keys = data.draw(st.lists(st.text(st.sampled_from("aAB3PD"), max_size=8), min_size=200, max_size=200))
    n, k = F.col("n"), F.col("k")
    got = values(spark, list(zip(names, keys)), "n string, k string", text.strip(n), text.norm_name(n),
                 text.clean_type(n), text.slice_match(n, k))
    for name, key, row in zip(names, keys, got):
        upper = name.strip().upper()
        assert row == (name.strip(), upper.replace(".PDF", "").strip(), name.replace("*", "").strip().upper(),
                       len(key) >= 6 and upper[:3] == key[3:6])


def test_date_texts(spark):
    rows = [(at(t),) for t in ("2024-03-05T14:05:09.123", "2024-12-25T00:00:00", "2024-01-01T12:30:00",
                               "2024-01-09T11:59:59")] + [(None,)]
    t = F.col("t")
    got = values(spark, rows, "t timestamp_ntz", dates.fmt_date(t), dates.fmt_time(t), dates.fmt_default(t),
                 dates.day_of(t))
    assert got == [
        ("05/03/2024", "14:05:09", "Mar  5 2024  2:05PM", at("2024-03-05")),
        ("25/12/2024", "00:00:00", "Dec 25 2024 12:00AM", at("2024-12-25")),
        ("01/01/2024", "12:30:00", "Jan  1 2024 12:30PM", at("2024-01-01")),
        ("09/01/2024", "11:59:59", "Jan  9 2024 11:59AM", at("2024-01-09")),
        (None, None, None, None)]


def test_times_do_not_move_with_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # Half past two does not exist there on that day.
        t = F.col("t")
        got = values(spark, [(at("2024-03-10T02:30:00"),)], "t timestamp_ntz", dates.fmt_time(t),
                     dates.fmt_default(t), dates.fmt_date(t), dates.day_of(t))
        assert got == [("02:30:00", "Mar 10 2024  2:30AM", "10/03/2024", at("2024-03-10"))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_last_week_of_every_day(spark):
    days = [dt.date(2023, 12, 20) + dt.timedelta(days=i) for i in range(40)]
    first, last = dates.last_week(F.col("d"))
    got = values(spark, [(d,) for d in days], "d date", first, last)
    for day, (sunday, saturday) in zip(days, got):
        assert (sunday, saturday) == dates.last_week_of(day)
        assert sunday.weekday() == 6 and saturday.weekday() == 5 and (saturday - sunday).days == 6
        assert 1 <= (day - saturday).days <= 7


@pytest.mark.parametrize("day, want", [
    (dt.date(2024, 1, 6), (dt.date(2023, 12, 24), dt.date(2023, 12, 30))),
    (dt.date(2024, 1, 7), (dt.date(2023, 12, 31), dt.date(2024, 1, 6))),
    (dt.date(2024, 1, 8), (dt.date(2023, 12, 31), dt.date(2024, 1, 6)))])
def test_last_week_around_a_saturday(day, want):
    assert dates.last_week_of(day) == want
