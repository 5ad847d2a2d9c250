import pytest
from pyspark.sql import functions as F

from wirelens.functions import dates, text

#: target, seller, target, seller, whether they are one deal
CASES = [
    ("Safety Products", "3M", "safety  products!", "3M", True),
    ("Water Filtration Pumps", "Acme", "Filtration Pumps Unit", "Acme", True),
    ("ContiTech", "Continental", "Continental Industrial Unit", "Continental", True),
    ("industrial division", "Bosch", "Rexroth", "Bosch", True),
    ("SWC", "Foo", "Smart World Communication", "Foo", True),
    ("Tea", "Unilever", "Unilever Steam Turbines", "Unilever", True),
    ("Blue Rock", "Acme", "Big Reef", "Acme", True),
    ("Alpha Beta", "Acme", "Abacus", "Acme", True),
    ("Lantiq", "Infineon", "Marioff", "Carrier", False),
    ("Alpha Pumps", "Acme", "Beta Valves", "Acme", False),
]


def test_deals_match(spark):
    df = spark.createDataFrame(CASES, "ta string, sa string, tb string, sb string, want boolean")
    got = df.select("ta", "want", text.deals_match(*map(F.col, ("ta", "sa", "tb", "sb"))).alias("got"), text.deals_match(*map(F.col, ("tb", "sb", "ta", "sa"))).alias("back")).collect()
    assert all(r["got"] == r["want"] == r["back"] for r in got), got


def test_norm_and_key(spark):
    df = spark.createDataFrame([("Safety Products (Division)", "3M Co.", "signing")], "t string, s string, g string")
    assert df.select(text.deal_key(F.col("t"), F.col("s"), F.col("g"))).first()[0] == "safety products division|3m co|signing"
    values = ["café Über-x", "- foo", "", None, "A  B\tC"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(text.norm(F.col("v"))).collect()]
    assert got == ["café überx", " foo", "", "", "a b c"]


def test_cap_text(spark):
    long = " ".join(["word"] * 1600)
    got = [r[0] for r in spark.createDataFrame([(long,), ("x" * 7000,), ("a  b",)], "v string").select(text.cap_text(F.col("v"))).collect()]
    assert got == [long[:6000], "x" * 6000, "a  b"]


@pytest.mark.parametrize(
    ("attr", "body", "href", "want"),
    [
        ("2024-03-15T10:00:00Z", "", "", "2024-03-15"),
        ("soon", "15 March 2024", "", "2024-03-15"),
        (None, "march 15, 2024", "", "2024-03-15"),
        (None, "2024-03-15", "", "2024-03-15"),
        (None, "04.02.26", "", "2026-04-02"),
        (None, "31 February 2024 or 2024-03-01", "", "2024-03-01"),
        (None, "", "/news/2026/03/15/x", "2026-03-15"),
        (None, "", "/news/2026/03/", "2026-03-01"),
        (None, "", "/news/x", None),
        (None, None, None, None),
    ],
)
def test_date_cascade(spark, attr, body, href, want):
    df = spark.createDataFrame([(attr, body, href)], "a string, t string, h string")
    assert df.select(F.date_format(dates.date_cascade(F.col("a"), F.col("t"), F.col("h")), "yyyy-MM-dd")).first()[0] == want


def test_feed_dates(spark):
    df = spark.createDataFrame([("Mon, 01 Jan 2024 10:00:00 GMT",), ("1 Jan 2024 10:00:00 +0200",), ("2024-01-01T10:00:00Z",), ("never",), (None,)], "d string")
    assert [r[0] for r in df.select(F.date_format(dates.feed_date(F.col("d")), "HH:mm")).collect()] == ["10:00", "08:00", "10:00", None, None]


def test_window_keeps_undated_and_the_boundary(spark):
    df = spark.sql("select * from values (timestamp'2024-01-30 00:00:00'), (timestamp'2024-01-29 23:59:59'), (null) as t(p)")
    assert df.where(dates.within(F.col("p"), F.lit("2024-01-31").cast("timestamp"), 24)).count() == 2
    assert df.where(dates.within(F.col("p"), F.lit("2024-01-31").cast("timestamp"), None)).count() == 3
