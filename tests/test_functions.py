"""Edge rows for the column functions (F1-F9), from FIXTURES.md §2."""

from pyspark.sql import functions as F

from storylens.functions import body_text, display_host, profile_key, redirect_host, split_get
from storylens.functions.strings import date_stamp


def _one(spark, expr, values, ddl="v string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_split_get_is_literal_one_based_and_null_safe(spark):
    got = _one(spark, split_get(F.col("v"), ".", 2), ["a.b.c", "abc", None, "a.", "a|b"])
    assert got == ["b", None, None, "", None]
    assert _one(spark, split_get(F.col("v"), "|", 2), ["a|b"]) == ["b"]


def test_redirect_host_edge_rows(spark):
    rows = {
        "https://l.example/?u=https%3A%2F%2Fwww.a.com%2Fp&e=1": "a.com",
        "https://l.example/?u=https%3A%2F%2Fa.com%2Fp&e=1": "a.com",
        "https://l.example/?u=https%3A%2F%2Fa.com&e=1": "a.com&e=1",
        "https://l.example/?u=https%3a%2f%2fa.com%2fp": None,
        "https://l.example/?u=https%3A%2F%2FWWW.a.com%2Fp": "WWW.a.com",
        "https://l.example/?u=https%3A%2F%2Fwww.a.www.b%2Fp": "a.b",
        "https://l.example/none": None,
        None: None,
    }
    assert _one(spark, redirect_host("v"), list(rows)) == list(rows.values())


def test_display_host_edge_rows(spark):
    rows = {"a.com/x": "a.com", "a.com": "a.com", "www.a.com/x": "www.a.com", "": "", None: None}
    assert _one(spark, display_host("v"), list(rows)) == list(rows.values())


def test_profile_key_edge_rows(spark):
    rows = {
        "https://site.example/ana/": "ana",
        "https://site.example/ana?x=1": "ana?x=1",
        "https://site.example/": "",
        "https://site.example": None,
        "site.example/ana": None,
        "site.example/ana/x/y": "y",
        None: None,
    }
    assert _one(spark, profile_key("v"), list(rows)) == list(rows.values())


def test_body_text_base64_rules(spark):
    df = spark.createDataFrame([
        ("aGVsbG8=", True), ("aGVs\nbG8=", True), ("YQ", True), ("a", True), ("***", True),
        ("plain", False), (None, False), ("Yf9i", True),
    ], "b string, f boolean")
    got = [r[0] for r in df.select(body_text("b", "f")).collect()]
    # unpadded YQ decodes; impossible length is NULL; no alphabet chars -> ''; bad UTF-8 dropped
    assert got == ["hello", "hello", "a", None, "", "plain", "", "ab"]


def test_date_stamp(spark):
    df = spark.createDataFrame([("2026-12-01",)], "d string")
    assert df.select(date_stamp(F.col("d").cast("date"))).first()[0] == "20261201"
