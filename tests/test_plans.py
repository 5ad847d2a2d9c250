import json

from pyspark.sql import functions as F

from wirelens.plans import scan as plans
from wirelens.sources import tables

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>
<item><title>Acme sells pumps unit</title><link>https://a.com/1</link><pubDate>Wed, 31 Jan 2024 08:00:00 GMT</pubDate><description>d</description></item>
<item><title>Acme pumps unit sold</title><link>https://a.com/2</link></item>
<item><title>Old news</title><link>https://a.com/3</link><pubDate>Mon, 01 Jan 2024 08:00:00 GMT</pubDate></item>
<item><title> </title><link>https://a.com/4</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Acme sells pumps unit</title><link href="https://a.com/1"/><updated>2024-01-31T09:00:00Z</updated></entry></feed>"""
PAGE = """<li><h3>Beta division sold to fund</h3><a href="/n/5">x</a><time datetime="2024-01-31"></time></li>"""


def providers():
    def classify(system, prompt):
        lines = [x for x in prompt.split("\n") if '. "' in x]
        rows = [{"deal_type": "corporate_carveout", "stage": "signing", "target_company": "Water Pumps" if "pumps" in line else "Beta", "seller": "Acme", "confidence": 60 + i, "reasoning": "r"} for i, line in enumerate(lines)]
        return json.dumps(rows), 100, 10

    def qualify(system, prompt):
        n = prompt.count('. "')
        return json.dumps([{"fit": 80, "pe_buyer": 90, "separation_complexity": 70, "recommended_action": "pursue"}] * n), 50, 5

    return classify, qualify


classify, qualify = providers()


def test_scan_twice(spark, tmp_path):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp")
    feed = spark.createDataFrame([("Acme", RSS), ("Other", ATOM), ("Broken", "<oops"), ("Empty", None)], "firm_name string, body string")
    press = spark.createDataFrame([("Beta", "beta.com", PAGE)], "firm_name string, domain string, body string")
    inputs = plans.Inputs(feeds=feed, press=press, bodies=spark.createDataFrame([("https://a.com/2", "<p>body text</p>")], "url string, body string"))
    got = plans.scan(inputs, plans.fresh_state(spark), now, plans.Workspace(spark, str(tmp_path / "one")), classify, qualify)
    alerts = {r["url"]: r for r in got.alerts.collect()}
    assert set(alerts) == {"https://a.com/1", "https://a.com/2", "https://beta.com/n/5"}
    assert alerts["https://a.com/2"]["summary"] == "body text"
    todo = got.actionable.collect()
    assert sorted(r["target_company"] for r in todo) == ["Beta", "Water Pumps"]
    assert any("[Also:" in r["reasoning"] for r in todo)
    assert got.documents.count() == 2
    counts = {r["stage"]: r["n"] for r in got.counts.collect()}
    assert counts == {"articles": 4, "distinct": 3, "new": 3, "with_text": 2, "with_seller": 3, "merged": 2, "unseen_deals": 2, "actionable": 2}
    assert "Scan parquet" not in got.counts._jdf.queryExecution().toString() and "FileScan" not in got.counts._jdf.queryExecution().toString()
    tables.write_state(got.state, str(tmp_path / "state"))
    again = tables.read_state(spark, str(tmp_path / "state"))
    assert (again["seen"].count(), again["seen_deals"].count()) == (3, 2)
    second = plans.scan(inputs, again, now, plans.Workspace(spark, str(tmp_path / "two")), classify, qualify)
    assert second.alerts.count() == 0
    plans.reset(spark, str(tmp_path / "state"))
    assert tables.read_state(spark, str(tmp_path / "state"))["seen"].count() == 0
    assert tables.read_state(spark, str(tmp_path / "missing"))["seen"].count() == 0


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    work = plans.Workspace(spark, str(tmp_path))
    none = spark.createDataFrame([], "id long")
    made = {"none": none, "some": spark.range(100), "filtered": spark.range(10).where("id > 20"), "joined": spark.range(100).join(none, "id"), "grouped": spark.range(90).groupBy((F.col("id") % 7).alias("id")).count()}
    for name, df in made.items():
        assert work.keep(df, name, low=F.col("id") < 3).count() == work.counts[name]["n"]
        assert work.counts[name]["low"] == df.where("id < 3").count()
    work.keep(spark.range(5), "some")
    assert work.counts["some"] == {"n": 5}


def test_model_outage_leaves_urls_unseen(spark, tmp_path):
    feed = spark.createDataFrame([("Acme", RSS)], "firm_name string, body string")

    def down(system, prompt):
        raise RuntimeError("no service")

    got = plans.scan(plans.Inputs(feeds=feed), plans.fresh_state(spark), F.lit("2024-01-31 12:00:00").cast("timestamp"), plans.Workspace(spark, str(tmp_path)), down, qualify)
    assert got.state["seen"].count() == 0 and got.alerts.count() == 2


def test_lookback_and_backtest(spark, tmp_path):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp")
    feed = spark.createDataFrame([("Acme", RSS)], "firm_name string, body string")
    press = spark.createDataFrame([("Beta", "beta.com", PAGE)], "firm_name string, domain string, body string")
    rows = plans.lookback(plans.Inputs(feeds=feed, press=press), now, plans.Workspace(spark, str(tmp_path / "l")), classify)
    assert rows.count() == 4 and len(rows.columns) == 11
    got = plans.backtest(feed, now, plans.Workspace(spark, str(tmp_path / "b")), classify).collect()
    assert [(r["deal_type"], r["n"]) for r in got] == [("corporate_carveout", 3)] and any(x.startswith("no date") for x in got[0]["lines"])


def test_streams(spark, tmp_path):
    from wirelens.streaming import jobs

    src = str(tmp_path / "log")
    spark.createDataFrame([("f", 0, "404"), ("f", 1, "404"), ("g", 0, "403")], "firm_name string, seq int, outcome string").write.parquet(src)
    out = {}

    def keep(batch, number):
        out.update({r["firm_name"]: r for r in batch.collect()})

    read = lambda: spark.readStream.schema("firm_name string, seq int, outcome string").parquet(src)
    jobs.run_available(jobs.error_state(read()), str(tmp_path / "ck"), keep, "update").awaitTermination()
    assert out["g"]["prefer_render"] and not out["f"]["needs_url_update"]
    spark.createDataFrame([("f", 2, "404"), ("f", 3, "ok")], "firm_name string, seq int, outcome string").write.mode("append").parquet(src)
    jobs.run_available(jobs.error_state(read()), str(tmp_path / "ck"), keep, "update").awaitTermination()
    assert (out["f"]["needs_url_update"], out["f"]["consecutive_404s"]) == (True, 0)

    art = str(tmp_path / "art")
    spark.sql("select * from values ('u', timestamp'2024-01-01'), ('u', timestamp'2024-01-02'), ('v', timestamp'2024-01-02') as t(url, fetched_at)").write.parquet(art)
    seen = []
    df = jobs.new_articles(spark.readStream.schema("url string, fetched_at timestamp").parquet(art))
    jobs.run_available(df, str(tmp_path / "ck2"), lambda b, n: seen.extend(r["url"] for r in b.collect())).awaitTermination()
    assert sorted(seen) == ["u", "v"]

    deals = spark.createDataFrame([("T", "S", "signing", 50, "a"), ("t", "s", "signing", 60, "b")], "target_company string, seller string, stage string, confidence int, title string")
    wrote = []
    write = jobs.each_batch(str(tmp_path / "deals"), lambda b: wrote.extend(r["title"] for r in b.collect()))
    write(deals, 0)
    write(deals, 1)
    assert wrote == ["b"]


def test_cli(capsys):
    from wirelens import cli

    assert cli.main([]) == 1 and "scan" in capsys.readouterr().out
    a = cli.parser().parse_args(["scan", "--hours", "5", "--skip-sink"])
    assert (a.hours, a.skip_sink) == (5, True)


def test_cli_scans_from_pages_to_sink(spark, tmp_path, monkeypatch, capsys):
    """Saved pages behind a fake web; a model and a sink by name; two runs; errors, bodies, press discovery and flags."""
    import sys
    import types

    from wirelens import cli
    from wirelens.plans import gather

    today = spark.sql("select date_format(current_timestamp(), 'EEE, dd MMM yyyy HH:mm:ss') d").first()["d"]
    rss = f"<rss><channel><item><title>Acme sells pumps unit</title><link>https://acme.com/1</link><pubDate>{today} +0000</pubDate></item></channel></rss>"
    press = '<li><h3>Beta division sold to fund</h3><a href="/n/5">x</a></li>'
    listing = "".join(f'<a href="/news/{i}">n</a>' for i in range(3)) + '<li><h3>Gamma sells its engines</h3><a href="/news/engines">x</a></li>'
    web = {"https://acme.com/feed.xml": (200, rss), "https://beta.com/press": (200, press), "https://gamma.com/press": (200, listing), "https://gone.com/feed": (404, ""), "https://shy.com/press": (403, ""),
           "https://acme.com/1": (200, "<article>" + "<p>pumps body text here</p>" * 20 + "</article>")}

    def get(url, head, timeout, verify):
        return web.get(url, (500, ""))

    def classify(system, prompt):
        if system.startswith("You score"):
            return json.dumps([{"fit": 80, "pe_buyer": 90, "separation_complexity": 70, "recommended_action": "pursue"}] * prompt.count('. "')), 50, 5
        lines = [x for x in prompt.split("\n") if '. "' in x]
        return json.dumps([{"deal_type": "corporate_carveout", "stage": "signing", "target_company": line.split('"')[1].split()[2], "seller": line.split('"')[1].split()[0], "confidence": 70, "reasoning": "r"} for line in lines]), 100, 10

    taken = str(tmp_path / "taken")

    def post(document):
        with open(taken, "a") as f:
            f.write(document + "\n")
        return "id"

    fake = types.ModuleType("fake_services")
    fake.classify, fake.post, fake.refuse = classify, post, lambda document: None
    monkeypatch.setitem(sys.modules, "fake_services", fake)
    monkeypatch.setattr(cli, "web", lambda a: gather.Web(get=get))
    monkeypatch.setattr(cli, "SINK_PAUSE", 0)
    targets = tmp_path / "t.yml"
    targets.write_text("firms:\n- {name: Acme, domain: acme.com, feed_url: 'https://acme.com/feed.xml', press_url: 'https://acme.com/none'}\n- {name: Beta, domain: beta.com, press_url: 'https://beta.com/press'}\n- {name: Gamma, domain: gamma.com}\n"
                       "- {name: Gone, domain: gone.com, feed_url: 'https://gone.com/feed', press_url: 'https://gone.com/feed'}\n- {name: Shy, domain: shy.com, press_url: 'https://shy.com/press'}\n")  # fmt: skip
    run = lambda sink, n: cli.main(["--targets", str(targets), "--state", str(tmp_path / "state"), "--work", str(tmp_path / f"work{n}"), "--provider", "fake_services:classify", "scan", "--sink", f"fake_services:{sink}"])
    try:
        run("refuse", 0)
        raise AssertionError("a run whose every write fails must raise")
    except RuntimeError:
        assert tables.read_state(spark, str(tmp_path / "state"))["seen"].count() == 0
    assert run("post", 1) == 0
    rows = [json.loads(x) for x in open(taken)]
    assert len(rows) == 3
    fresh = spark.read.parquet(str(tmp_path / "work1" / "fresh"))
    assert fresh.where("url = 'https://acme.com/1'").first()["summary"].startswith("pumps body text")
    errors = {r["firm_name"]: r for r in tables.read_state(spark, str(tmp_path / "state"))["firm_errors"].collect()}
    assert (errors["Gone"]["consecutive_404s"], errors["Gone"]["needs_url_update"]) == (2, False) and errors["Shy"]["prefer_render"] and errors["Beta"]["last_error"] is None
    assert "gamma.com/press" in targets.read_text() and tables.last_run(spark, str(tmp_path / "state"))
    out = capsys.readouterr().out
    assert "classify: 100 tokens in" in out and "actionable" in out
    assert run("post", 2) == 0 and len(open(taken).readlines()) == 3
    errors = {r["firm_name"]: r for r in tables.read_state(spark, str(tmp_path / "state"))["firm_errors"].collect()}
    assert errors["Gone"]["needs_url_update"] and "need a new address: Gone" in capsys.readouterr().out


def test_cli_discovers_feeds_and_imports_state(spark, tmp_path, monkeypatch, capsys):
    """A feed that the home page links to, one under a usual path, none; the flag of a repaired firm goes."""
    from wirelens import cli
    from wirelens.plans import gather

    rss = "<rss><channel><item><title>t</title><link>https://x/1</link></item></channel></rss>"
    home = '<html><link rel="alternate" type="application/rss+xml" href="/own.xml"></html>'
    web = {"https://a.com": home, "https://a.com/own.xml": rss, "https://a.com/feed": rss, "https://b.com/news/rss": rss}
    monkeypatch.setattr(cli, "web", lambda a: gather.Web(get=lambda url, head, timeout, verify: (200, web[url]) if url in web else (404, "")))
    targets, state = tmp_path / "t.yml", str(tmp_path / "state")
    targets.write_text("firms:\n- {name: A, domain: a.com}\n- {name: B, domain: b.com, press_url: 'https://b.com/press'}\n- {name: C, domain: c.com}\n- {name: D, feed_url: 'https://d/feed'}\n")
    doc = tmp_path / "state.json"
    doc.write_text(json.dumps({"seen": {"https://x/1": {"hash": "h", "first_seen": "2024-01-01T00:00:00"}}, "firm_errors": {"A": {"consecutive_404s": 3, "needs_url_update": True}}}))
    assert cli.main(["--state", state, "import-state", str(doc)]) == 0
    assert tables.read_state(spark, state)["seen"].count() == 1
    assert cli.main(["--targets", str(targets), "--state", state, "--work", str(tmp_path / "w"), "discover", "--update"]) == 0
    feeds = {r["name"]: r["feed_url"] for r in tables.firms(spark, str(targets)).collect()}
    assert feeds == {"A": "https://a.com/own.xml", "B": "https://b.com/news/rss", "C": None, "D": "https://d/feed"}
    assert not tables.read_state(spark, state)["firm_errors"].first()["needs_url_update"]
    assert cli.main(["--targets", str(targets), "--state", state, "--work", str(tmp_path / "w2"), "lookback", "--output", str(tmp_path / "csv"), "--skip-fetch"]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
    assert cli.main(["--targets", str(targets), "--state", state, "--work", str(tmp_path / "w3"), "backtest"]) == 0


def test_services():
    import pytest

    from wirelens.sources import providers

    chat = providers.HttpModel("u", "m", post=lambda url, body, key, timeout: {"content": [{"text": body["messages"][0]["content"]}], "usage": {"input_tokens": 3, "output_tokens": 2}})
    other = providers.HttpModel("u", "m", post=lambda url, body, key, timeout: {"choices": [{"message": {"content": "x"}}], "usage": {"prompt_tokens": 1, "completion_tokens": 1}})
    assert chat("s", "p") == ("p", 3, 2) and other("s", "p") == ("x", 1, 1)

    def fails(*a):
        raise TimeoutError

    assert providers.HttpSink("u", post=lambda *a: {"id": "7"})("{}") == "7" and providers.HttpSink("u", post=fails)("{}") is None
    assert providers.model(None) is None and providers.sink(None) is None and providers.load("json:loads") is json.loads
    for wrong in (lambda: providers.sink("https://sink"), lambda: providers.load("json")):
        with pytest.raises(ValueError):
            wrong()


def test_time_budget_leaves_sources_unfinished(spark):
    from wirelens.sources import fetch

    urls = spark.createDataFrame([(f"https://x/{i}", f"f{i}") for i in range(4)], "url string, firm_name string")
    log = fetch.fetch(urls, lambda *a: (200, "ok"), budget=0)
    assert log.count() == 4 and fetch.unfinished(log).count() == 4


def test_dimension_file(spark, tmp_path):
    p = tmp_path / "t.yml"
    p.write_text("firms:\n- {name: A, domain: a.com, extra: 1}\n- {name: B, sectors: [x]}\n")
    df = tables.firms(spark, str(p))
    assert df.count() == 2
    tables.write_firms(df, str(p))
    assert tables.firms(spark, str(p)).collect() == df.collect()
    p.write_text("other: 1\n")
    assert tables.firms(spark, str(p)).count() == 0


def test_rss_parse_reads_every_event(spark, sf):
    from wirelens.plans import queries

    got = [r["url"] for r in queries.queries()["rss_parse"](spark, sf).select("url").collect()]
    want = [f"https://x.example.com/{r['event_id']}" for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect()]
    assert sorted(got) == sorted(want)


def plain_fold(rows):
    """The fold in Python, by stage alone: the representatives' rows, with notes. Rows have ord, title, target, seller, stage, confidence, reasoning."""
    from wirelens.functions import text

    r = rows.select("ord", "title", "target", "seller", "stage", "confidence", "reasoning")
    names = r.select("stage", F.struct("target", "seller").alias("n")).distinct()
    pairs = names.withColumnRenamed("n", "a").join(names.withColumnRenamed("n", "b").withColumnRenamed("stage", "s"), F.col("stage").eqNullSafe(F.col("s")))
    match = {tuple(x) for x in pairs.where(text.deals_match(F.col("a.target"), F.col("a.seller"), F.col("b.target"), F.col("b.seller"))).select("a.target", "a.seller", "b.target", "b.seller").distinct().collect()}
    reps = []
    for row in sorted((x.asDict() for x in r.collect()), key=lambda x: x["ord"]):
        for k, rep in enumerate(reps):
            if rep["stage"] == row["stage"] and (rep["target"], rep["seller"], row["target"], row["seller"]) in match:
                new, old = (row, rep) if row["confidence"] > rep["confidence"] else (rep, row)
                reps[k] = new | {"reasoning": f"{new['reasoning']}\n[Also: {old['title']}]"}
                break
        else:
            reps.append(row)
    return reps


def test_greedy_deal_dedup_folds_every_deal(spark, sf):
    from wirelens.plans import queries

    columns = ["ord", "stage", "seller", "target", "confidence", "reasoning"]
    got = queries.queries()["greedy_deal_dedup"](spark, sf).select(columns).collect()
    want = plain_fold(queries.deals(lambda name: spark.read.parquet(f"{sf}/{name}.parquet")))
    assert sorted(map(tuple, got)) == sorted(tuple(x[c] for c in columns) for x in want)
    assert min(x["confidence"] for x in got) <= 25


def test_mini_scan_folds_across_sellers(spark, sf):
    from collections import Counter

    from wirelens.operators import dedup, filters
    from wirelens.plans import queries

    a = dedup.keep_first(queries.scored(lambda name: spark.read.parquet(f"{sf}/{name}.parquet")), ["url"], ["published", "ord"])
    good = filters.alerts_to_score(a.where("ord % 9 <> 0")).withColumn("target", F.col("target_company"))
    action = {r["ord"]: (r["stage"], r["recommended_action"], r["fit"]) for r in good.collect()}
    kept = [action[x["ord"]] for x in plain_fold(good)]
    n = Counter(x[:2] for x in kept)
    want = {(*k, c, max(x[2] for x in kept if x[:2] == k)) for k, c in n.items()}
    got = queries.queries()["mini_scan"](spark, sf).select("stage", "recommended_action", "n", "best").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
