"""Cleaning expressions on the edge rows of FIXTURES §3."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.config import CatalogConfig
from marquee.functions import (clean_title, first_digit_run, is_digits, parse_date, strip_blanks,
                               to_double, to_int_id)
from marquee.operators.clean import clean_server


def _one(spark, values, expr, schema="t string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("t"))).collect()]


def test_ids(spark):
    got = _one(spark, ["  11  ", "\t11\n", "11.5", "1e3", "", "abc", "0x10", "1,000", "ID-ERR",
                       "99999999999999999999", "inf", None], to_int_id)
    assert got == [11, 11, 11, 1000, None, None, None, None, None, None, None, None]


def test_plays_first_digit_run(spark):
    got = _one(spark, ["8578 views", "6863", "N/A", "", None, "1.500 visitas", "-5",
                       "abc 12 def 34"], first_digit_run)
    assert got == [8578, 6863, None, None, None, 1, 5, 12]


def test_plays_thousands_option(spark):
    cfg = CatalogConfig(thousands_sep=".")
    got = _one(spark, ["1.500 visitas", "2.345.678", "8578 views", "12.5"],
               lambda c: first_digit_run(c, cfg.thousands_sep))
    assert got == [1500, 2345678, 8578, 12]


def test_dates(spark):
    got = _one(spark, ["2025-05-12", "12/05/2025", "2025-5-1", "1/5/2025", "00/00/0000",
                       "2025-02-30", "2025-05-12 10:00:00", "25-05-12", "Por confirmar",
                       "SIN FECHA", "", None, " 2025-05-12 "], parse_date)
    d = dt.date
    assert got == [d(2025, 5, 12), d(2025, 5, 12), d(2025, 5, 1), d(2025, 5, 1), None, None, None,
                   None, None, None, None, None, d(2025, 5, 12)]


def test_titles(spark):
    got = _one(spark, ["SPIDER-MAN", "L'AMOUR", "2ND 3D", "IT'S A", "1917", "  The   Matrix ",
                       "   ", None, "Mixed CASE", "ÉTÉ À  PARIS"], clean_title)
    assert got == ["Spider-Man", "L'Amour", "2Nd 3D", "It'S A", "1917", "The Matrix", None, None,
                   "Mixed CASE", "Été À Paris"]


def test_titles_match_python_title(spark):
    samples = ["SPIDER-MAN 2ND", "--AB--CD", "ǄEMAL", "ÀB.CD,EF", "X-", "A1B2C3"]
    got = _one(spark, samples, clean_title)
    assert got == [s.title() for s in samples]


def test_strip_unicode_blanks(spark):
    got = _one(spark, [" x　", "\x1c y \x1f", " z "], strip_blanks)
    assert got == ["x", "y", "z"]


def test_servers(spark):
    df = spark.createDataFrame([(v,) for v in [" null_server ", "NULL_SERVER", "Null_Server", "  ",
                                               " Nodo_Valle_Tres ", None]], "servidor_origen string")
    got = [r[0] for r in df.select(clean_server()).collect()]
    assert got == [None, None, None, None, "Nodo_Valle_Tres", None]


def test_nan_becomes_null(spark):
    got = _one(spark, [float("nan"), 81.0, None], to_double, "t double")
    assert got == [None, 81.0, None]


def test_digits_only(spark):
    got = _one(spark, [" 123 ", "12a", "", None, "٣"], is_digits)
    assert got == [True, False, False, False, False]
