"""Truth tables of the scalar functions."""

import datetime as dt
import hashlib
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from adjudika import functions as fn


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", f(F.col("s")).alias("o")).orderBy("i").collect()]


def check(spark, f, table):
    assert apply(spark, f, [k for k, _ in table]) == [v for _, v in table]


def test_clean_text(spark):
    check(spark, fn.clean_text, [
        (None, None), ("", None), ("   ", ""), ("  Test   avec   espaces  ", "Test avec espaces"),
        (" a  b\x1f", "a b"), ("a\n\r\n\tb", "a b")])


def test_long_text_is_collapsed_then_cut(spark):
    df = spark.createDataFrame([("x " * 1000, "y" * 1001)], "titre string, autre string")
    row = fn.normalize_strings(df).first()
    assert len(row.titre) == 1000 and row.titre.startswith("x x") and len(row.autre) == 1001


def test_parse_amount(spark):
    check(spark, fn.parse_amount, [
        ("1 234 567,89 DH", 1234567.89), ("12 000,00 Dhs.", None), ("1.234,5", None), ("-5", 5.0), ("", None),
        (None, None), (".", None), ("abc", None)])


def test_clean_amount(spark):
    check(spark, fn.clean_amount, [
        ("1 234 567,89", None), ("12,5", 12.5), ("-5", -5.0), ("1_0", 10.0), ("1d", None), ("1e3", 1000.0), ("", None),
        (None, None), ("inf", float("inf"))])


def test_parse_datetime(spark):
    check(spark, fn.parse_datetime, [
        ("3/1/2025", dt.datetime(2025, 1, 3)), ("31/02/2025", None), ("2025-10-23", dt.datetime(2025, 10, 23)),
        (" 23-10-2025  14:30 ", dt.datetime(2025, 10, 23, 14, 30)), ("23/10/2025 10:00", None), ("zz", None),
        ("2025-10-23 10:00", None), ("\x012025-10-23", None), ("", None), (None, None), ("1-1-2025 24:00", None),
        ("003/01/2025", None), ("00/01/2025", None)])


def test_parse_date(spark):
    check(spark, fn.parse_date, [
        ("23/10/2025", dt.date(2025, 10, 23)), ("2025-1-2", dt.date(2025, 1, 2)), ("23-10-2025 14:30", None)])


@pytest.mark.parametrize("zone", ["UTC", "Africa/Casablanca", "America/Sao_Paulo"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight of 4 November 2018 does not exist in Sao Paulo.
        assert apply(spark, fn.parse_datetime, ["04/11/2018"]) == [dt.datetime(2018, 11, 4)]
        assert apply(spark, lambda c: fn.casablanca_today(F.lit("2025-07-01 23:30:00").cast("timestamp_ntz")), ["x"]) == [
            dt.date(2025, 7, 2)]
        assert apply(spark, lambda c: fn.utc_iso_seconds(F.lit("2025-07-01 23:30:00").cast("timestamp_ntz")), ["x"]) == [
            "2025-07-01T23:30:00+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_or_blank(spark):
    check(spark, lambda c: fn.iso_or_blank(c.cast("timestamp_ntz")), [
        ("2025-01-31 08:00:00", "2025-01-31T08:00:00"), ("2025-01-31 08:00:00.5", "2025-01-31T08:00:00.500000"), (None, "")])


def test_deadline_from_cells(spark):
    df = spark.createDataFrame([
        ("Rabat", "25/12/2025 10:00", "01/01/2026"), ("A - B", "le 01/2025", ""), (None, None, None),
        ("5-1-2025", "", "")], "a string, b string, c string")
    got = [r.o for r in df.select(fn.deadline_from_cells([F.col("a"), F.col("b"), F.col("c")]).alias("o")).collect()]
    assert got == ["2025-12-25", "le 01/2025", "", "2025-01-05"]


def test_labels(spark):
    check(spark, fn.normalize_type_marche, [
        ("Travaux et services", "travaux"), ("Étude", "etudes"), ("ETUDES", "etudes"), ("Fourniture", "fournitures"),
        ("Services", "services"), ("Autre", "autre"), ("", None), (None, None)])
    check(spark, fn.normalize_statut, [
        ("Concours", "en_cours"), ("Clôturé", "cloture"), ("cloturee", "cloture"), ("Annulé", "annule"),
        ("Reporté", "reporté"), ("", "en_cours"), (None, "en_cours")])


@pytest.mark.parametrize("base", ["https://h.ma/a/b?x=1#f", "https://h.ma", "https://h.ma/a/b/c/"])
def test_url_join_agrees_with_the_standard_library(spark, base):
    hrefs = ["", "x", "/x?y", "?q", "#z", "//o/p", "http://u/v", "../c/./d", "../../..", "mailto:a", "javascript:x",
             "./", "..", "x/../y?u=../z", "/a/../b"]
    assert apply(spark, lambda c: fn.url_join(base, c), hrefs) == [urljoin(base, h) for h in hrefs]


def test_query_param_and_canonical_url(spark):
    check(spark, lambda c: fn.query_param(c, "refConsultation"), [
        ("/i?refConsultation=&refConsultation=a%20b+c&orgAcronyme=x", "a b c"), ("nope", None), ("", None),
        ("/i?xrefConsultation=1", None), ("/i?p=1&refConsultation=%zz#refConsultation=3", "%zz"), ("/i#?refConsultation=1", None)])
    out = apply(spark, fn.canonical_detail_url, ["http://x/?orgAcronyme=o&z=1&refConsultation=5#f", "http://x/?refConsultation=5"])
    assert out[0].endswith("&refConsultation=5&orgAcronyme=o") and out[1] == "http://x/?refConsultation=5"


def test_small_url_helpers(spark):
    check(spark, fn.to_desktop, [("https://h/mobile/x?u=/mobile/y", "https://h/x?u=/mobile/y")])
    check(spark, fn.with_mobile_out, [("/mobile/i?a", "/i?a&mobile=out"), ("/mobile/i", "/i?mobile=out"), ("/i", "/i")])
    check(spark, lambda c: fn.reject_javascript(c, ""), [("javascript:a()", ""), ("/a", "/a")])
    check(spark, fn.reject_javascript, [("javascript:a()", None)])
    check(spark, fn.site_absolute, [("/a", f"{fn.urls.BASE_URL}/a"), ("a", f"{fn.urls.BASE_URL}/a"), ("http://b", "http://b")])
    check(spark, fn.strip_mailto, [("mailto:a@b", "a@b")])


def test_detail_url_chain(spark):
    row = "s string, f string, k string, r string, o string"
    df = spark.createDataFrame([("/a", "/b", None, "r", "o"), ("", "/b", None, "r", "o"), (None, None, None, "r", "o"),
                                (None, "", None, "", "o")], row)
    got = [r.o for r in df.select(fn.detail_url_chain(F.lit("https://h/p"), *(F.col(c) for c in "sfkro")).alias("o")).collect()]
    assert got[:2] == ["https://h/a", "https://h/b"] and got[2].endswith("&refConsultation=r&orgAcronyme=o") and got[3] == ""


def test_keys(spark):
    df = spark.createDataFrame([(None, None, None), ("E", "R", "D")], "a string, b string, c string")
    got = [r.o for r in df.select(fn.record_uid(F.col("a"), F.col("b"), F.col("c")).alias("o")).collect()]
    assert got == [hashlib.sha256(s.encode()).hexdigest() for s in ("||", "E|R|D")]
    assert apply(spark, fn.content_hash, ["é"]) == [hashlib.md5("é".encode()).hexdigest()[:8]]
