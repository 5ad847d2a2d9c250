"""Payload files and cursor pages as data sources."""

import os
import time

from pyspark.sql import functions as F

from wirelens.plans import queries
from wirelens.sources import readers, tables

RSS = "<rss><channel><item><title>{0}</title><link>https://a.com/{0}</link></item></channel></rss>"


def articles(df):
    return tables.feed_articles(df, F.lit("2024-01-31").cast("timestamp"), None).select("firm_name", "title", "url")


def test_files_give_the_rows_of_the_table(spark, tmp_path):
    feeds = spark.createDataFrame([("A & B/C.d", RSS.format("x")), ("Ünï", RSS.format("ü")), ("Ünï", RSS.format("z")), ("empty", ""), ("none", None)], "firm_name string, body string")
    folder = str(tmp_path / "in")
    readers.save(feeds, folder)
    assert not [f for f in os.listdir(folder) if f.endswith(".part")] and len(os.listdir(folder)) == 5
    got = readers.load(spark, folder)
    assert sorted(map(tuple, articles(got).collect())) == sorted(map(tuple, articles(feeds).collect()))
    assert got.count() == 5 and readers.load(spark, str(tmp_path / "missing")).count() == 0
    small = spark.read.format("wirelens_payloads").option("partitionBytes", 1).load(folder)
    assert small.rdd.getNumPartitions() >= 4 and small.count() == 5
    (tmp_path / "in" / "bad.payload").write_bytes(b"\xff<oops")
    assert readers.load(spark, folder).where("firm_name = 'bad'").first()["body"] == "�<oops"


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, got = str(tmp_path / "in"), []

    def run(settle=0.0):
        got.clear()
        df = articles(readers.load_stream(spark, folder, settle))
        df.writeStream.foreachBatch(lambda b, n: got.extend(r["title"] for r in b.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        return sorted(got)

    one = lambda *names: readers.save(spark.createDataFrame([(n, RSS.format(n)) for n in names], "firm_name string, body string"), folder)
    one("a", "b")
    assert run(settle=3600) == []  # too young to be taken
    time.sleep(0.05)
    assert run() == ["a", "b"]
    assert run() == []
    one("0")  # a name before those that were taken
    time.sleep(0.05)
    assert run() == ["0"]


def test_cursor_pages_are_partitions(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def ask(body):
        with open(calls, "a") as f:
            f.write("x")
        at = int(body.get("start_cursor") or 0)
        return {"results": [{"id": f"p{at}-{i}", "properties": {"Verdict": {"type": "select", "select": {"name": "Confirmed"}}}} for i in range(2)], "has_more": at < 3, "next_cursor": str(at + 1)}

    rows = readers.reviews(spark, ask, str(tmp_path / "j"))
    assert rows.rdd.getNumPartitions() == 4
    assert sorted((r["page_id"], r["verdict"]) for r in rows.collect()) == [(f"p{a}-{i}", "Confirmed") for a in range(4) for i in range(2)]
    assert readers.reviews(spark, ask, str(tmp_path / "j")).count() == 8
    assert len(open(calls).read()) == 4


def test_query_over_files_equals_the_query_over_rows(spark, sf):
    q = queries.queries()
    assert sorted(map(tuple, q["feed_files"](spark, sf).collect())) == sorted(map(tuple, q["rss_parse"](spark, sf).collect()))
