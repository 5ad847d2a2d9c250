import itertools
import random

import pytest
from pyspark.sql import functions as F

from wirelens.functions import model_json, scoring, text
from wirelens.operators import dedup, discovery, feedback, filters, model_stage, sink, state
from wirelens.sources import fetch, tables


def fold(spark, rows):
    df = spark.createDataFrame([(i, t, tg, "Acme", c, "r", "signing") for i, (t, tg, c) in enumerate(rows)], "ord long, title string, target string, seller string, confidence int, reasoning string, stage string")
    return [(r["title"], r["confidence"], r["reasoning"]) for r in dedup.fold_repeats(df, ["stage"]).orderBy("place").collect()]


def test_fold_goldens(spark):
    same = "Water Pumps"
    assert fold(spark, [("A", same, 60), ("B", same, 70), ("C", same, 65)]) == [("B", 70, "r\n[Also: A]\n[Also: C]")]
    assert fold(spark, [("A", same, 60), ("B", same, 60)]) == [("A", 60, "r\n[Also: B]")]
    assert fold(spark, [("A", same, 60), ("B", same, 50), ("C", same, 90)]) == [("C", 90, "r\n[Also: A]")]


def test_fold_equals_a_plain_loop(spark):
    r = random.Random(4)
    names = ["Water Pumps", "Pumps Unit Water", "Valves", "Steel Valves Parts", "SVP", "Rotor Blades", "Blades of Rotor"]
    rows = [(i, f"t{i}", r.choice(names), "Acme", r.randint(0, 5), "", r.choice(["a", "b"])) for i in range(60)]
    pairs = spark.createDataFrame(list(itertools.product(names, names)), "a string, b string")
    match = {(x["a"], x["b"]): x["m"] for x in pairs.select("a", "b", text.deals_match(F.col("a"), F.lit("Acme"), F.col("b"), F.lit("Acme")).alias("m")).collect()}
    reps = []
    for row in rows:
        for k, rep in enumerate(reps):
            if rep[6] == row[6] and match[rep[2], row[2]]:
                new, old = (row, rep) if row[4] > rep[4] else (rep, row)
                reps[k] = (*new[:5], new[5] + f"\n[Also: {old[1]}]", new[6])
                break
        else:
            reps.append(row)
    df = spark.createDataFrame(rows, "ord long, title string, target string, seller string, confidence int, reasoning string, stage string")
    got = dedup.fold_repeats(df, ["stage"]).collect()
    assert sorted((x["title"], x["confidence"], x["reasoning"], x["stage"]) for x in got) == sorted((x[1], x[4], x[5], x[6]) for x in reps)


def test_errors_table_takes_a_run(spark):
    from wirelens import schemas
    from wirelens.operators import state

    old = spark.createDataFrame([("a", "404", "d", 2, False, False), ("b", "404", "d", 2, True, False), ("c", "403", "d", 0, False, True), ("idle", "404", "d", 1, False, False)], schemas.FIRM_ERRORS)
    log = spark.createDataFrame([("a", 0, "404"), ("a", 1, "ok"), ("b", 0, "ok"), ("c", 0, "timeout"), ("new", 0, "403"), ("new", 1, None), ("late", 0, None)], "firm_name string, seq int, outcome string")
    got = {x["firm_name"]: tuple(x)[1:] for x in state.record(old, log, ["seq"], F.lit("now")).collect()}
    assert got == {"a": (None, None, 0, True, False), "b": (None, None, 0, True, False), "c": ("timeout", "now", 0, False, True), "idle": ("404", "d", 1, False, False), "new": ("403", "now", 0, False, True)}


def test_keep_first_is_idempotent(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 3, None)], "url string, ord int, x string")
    once = dedup.keep_first(df, ["url"], ["ord"])
    assert sorted(map(tuple, once.collect())) == [("u", 1, "a"), ("v", 3, None)] == sorted(map(tuple, dedup.keep_first(once, ["url"], ["ord"]).collect()))


def test_unseen_deals(spark):
    seen = spark.createDataFrame([("safety products", "3m co", "signing"), ("generic thing", "the group", "closing")], "target string, seller string, stage string")
    deals = spark.createDataFrame(
        [(0, "Safety Products Unit", "3M Co.", "signing"), (1, "Safety Products Unit", "3M Co.", "closing"), (2, "Safety Products", "N/A", "signing"), (3, "", "3M", "signing"), (4, "Safety Products", "Other Inc", "signing"), (5, "Generic Thing", "Someone", "closing")],
        "id int, target string, seller string, stage string",
    )
    assert sorted(r["id"] for r in dedup.unseen_deals(deals, seen).collect()) == [1, 2, 3, 4]


def test_state(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    s = spark.createDataFrame([("old", "h", "2023-01-01T00:00:00"), ("new", "h", "2024-01-30T00:00:00"), ("bad", "h", "x"), ("none", "h", None)], "url string, hash string, first_seen string")
    kept = state.prune(s, now)
    assert [r["url"] for r in kept.collect()] == ["new"]
    marked = state.mark_seen(kept, spark.createDataFrame([("new",), ("more",), ("more",)], "url string"), now)
    assert sorted(r["url"] for r in marked.collect()) == ["more", "new"]


@pytest.mark.parametrize(("outcomes", "streak", "flag"), [(["404"] * 3, 3, True), (["404", "404", "ok", "404"], 1, False), (["404"] * 3 + ["ok"], 0, True), (["404", "timeout", "404", "404"], 3, True)])
def test_streaks(spark, outcomes, streak, flag):
    log = spark.createDataFrame([("f", i, o) for i, o in enumerate(outcomes)], "firm string, seq int, outcome string")
    r = state.firm_errors(log, "firm", ["seq"]).first()
    assert (r["consecutive_404s"], r["needs_url_update"]) == (streak, flag)


def verdicts(spark, values):
    return spark.createDataFrame([(str(i), f"t{i}", v, "pursue", "corporate_carveout", "T", "S", "5") for i, v in enumerate(values)], "page_id string, title string, verdict string, action string, deal_type string, target string, seller string, score string")


def test_accuracy(spark):
    s = feedback.summary(verdicts(spark, ["Confirmed"] * 2 + ["Low EV", "Duplicate", "Pending"])).first()
    assert (s["total"], s["reviewed"], s["pending"], s["precision"]) == (5, 4, 1, 0.5)
    text_ = feedback.report(verdicts(spark, ["Low EV"] * 15))
    assert text_.count("  [Low EV]") == 10


def test_empty_accuracy(spark):
    empty = verdicts(spark, ["Pending"]).where("false")
    assert tuple(feedback.summary(empty).first()) == (0, 0, 0, 0, 0, 0.0)


def test_json_array(spark):
    replies = ['[{"a": 1}]', '```json\n[1]\n```', "Sure: [1, [2]] bye", "[[1], [2]]", "none", "[1", '["]"]', None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in replies], "r string").select(model_json.json_array(F.col("r"))).collect()]
    assert got == ['[{"a": 1}]', "[1]", "[1, [2]]", "[[1], [2]]", None, None, '["]', None]


def test_scores_and_workers(spark):
    cases = [(80, 0, 70, "pursue", 30, "discard"), (80, 100, 0, "pursue", 25, "discard"), (80, 0, 0, "pursue", 25, "discard"), (20, 0, 70, "monitor", 20, "discard"), (80, 100, 70, "pursue", 80, "pursue")]
    df = spark.createDataFrame(cases, "fit int, b int, s int, a string, fit2 int, a2 string")
    fit, action = scoring.capped(F.col("fit"), F.col("a"), F.col("b"), F.col("s"))
    assert df.where((fit != F.col("fit2")) | (action != F.col("a2"))).count() == 0
    assert [scoring.workers(n) for n in (0, 5, 50, 150, 250, 500)] == [10, 10, 10, 15, 25, 32]
    assert (scoring.workers(1000, cap=20), scoring.workers(1, floor=4, cap=20), scoring.workers(100, floor=1, cap=100, each=5)) == (20, 4, 20)


def test_batches_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(model_stage, "NUMBER_ROWS", 7)
    df = spark.createDataFrame([(i % 5, None if i == 3 else i) for i in range(100)], "a int, b int")
    rows = model_stage.batches(df, ["a", "b"], 20).collect()
    want = sorted(((i % 5, None if i == 3 else i) for i in range(100)), key=lambda x: (x[0], -1 if x[1] is None else x[1]))
    assert [(r["a"], r["b"]) for r in sorted(rows, key=lambda r: (r["batch"], r["pos"]))] == want


def test_batches(spark):
    got = model_stage.batches(spark.range(0, 45).toDF("id"), ["id"], 20).orderBy("id").collect()
    assert [(r["batch"], r["pos"]) for r in got] == [(i // 20, i % 20) for i in range(45)]


def test_model_stage_retries_and_defaults(spark, tmp_path):
    from wirelens.plans.scan import Workspace

    work = Workspace(spark, str(tmp_path))
    articles = spark.createDataFrame([(i, f"title {i}", f"u{i}", "s") for i in range(3)], "ord int, title string, url string, summary string")

    def good(system, prompt):
        return '```json\n[{"deal_type": "corporate_carveout", "stage": "signing", "confidence": 80, "seller": "S"}, {"deal_type": "merger", "confidence": 10}]\n```', 10, 2

    alerts, usage = model_stage.classify(articles, good, ["ord"], work.keep)
    rows = alerts.orderBy("ord").collect()
    assert [(r["deal_type"], r["is_carveout"], r["confidence"], r["seller"]) for r in rows] == [("corporate_carveout", True, 80, "S"), (None, False, 10, ""), (None, False, 0, "")]
    assert tuple(model_stage.usage(usage).first()) == (10, 2, (10 * 15 + 2 * 75) / 1e6)
    bad, usage = model_stage.classify(articles, lambda s, p: ('[{"confidence": 72.5}]', 1, 1), ["ord"], work.keep)
    assert {r["confidence"] for r in bad.collect()} == {0} and usage.first()["tokens_in"] == 3
    none, _ = model_stage.classify(articles, None, ["ord"], work.keep)
    assert none.where("deal_type is not null").count() == 0


def test_fetch_errors():
    def get(*answers):
        it = iter(answers)

        def run(url, head, timeout, verify):
            a = next(it)
            if isinstance(a, Exception):
                raise a
            return a

        return run

    import ssl

    waits = []
    one = lambda *a, **k: fetch.fetch_one("u", get(*a), sleep=waits.append, **k)
    assert one((200, "x"))["body"] == "x"
    assert one((404, ""))["error_type"] == "404" and one((500, ""))["error_type"] == "http_error"
    assert one(TimeoutError())["error_type"] == "timeout"
    assert one(*[ConnectionError()] * 3)["error_type"] == "dns" and waits == [1, 2]
    assert one(ConnectionError(), (200, "y"))["body"] == "y"
    assert one(ssl.SSLError(), (200, "z"), unverified=True) == {"status": 200, "body": "z", "error_type": None, "used_render": False, "tls_fallback": True}
    assert one(ssl.SSLError())["error_type"] == "ssl"
    assert one((403, ""))["error_type"] == "403" and one((403, ""), render=lambda u: "page")["used_render"]


def test_verdict_pages(spark):
    import json

    def row(i, verdict):
        return {"id": str(i), "properties": {"Alert": {"type": "title", "title": [{"plain_text": "A"}, {"plain_text": "b"}]}, "Verdict": {"type": "select", "select": verdict and {"name": verdict}}, "%": {"type": "number", "number": 7}, "Odd": {"type": "date"}, "URL": {"url": None}}}

    pages = {None: {"results": [row(1, "Confirmed")], "has_more": True, "next_cursor": "c"}, "c": {"results": [row(2, None)], "has_more": False}}
    got = tables.verdicts(spark, [json.dumps(p) for p in fetch.paged(lambda body: pages[body.get("start_cursor")])]).orderBy("page_id").collect()
    assert [(r["title"], r["verdict"], r["score"], r["url"]) for r in got] == [("Ab", "Confirmed", "7", ""), ("Ab", "", "7", "")]


def test_routes(spark):
    firms = tables.firms_from(spark, [{"name": n, "domain": "d", "press_url": p} for n, p in (("a", "x"), ("b", None), ("c", "x"), ("d", "x"))])
    errors = spark.createDataFrame([("a", True, False), ("c", False, True)], "firm_name string, needs_url_update boolean, prefer_render boolean")
    assert {r["name"]: r["route"] for r in filters.route(firms, errors).collect()} == {"a": "skip", "b": "discover", "c": "render", "d": "plain"}


def test_discovery(spark):
    firms = tables.firms_from(spark, [{"name": "Alpha", "domain": "a.com", "press_url": "https://a.com/p/"}, {"name": "Alpha Two", "domain": ""}])
    pages = spark.createDataFrame([("https://a.com", '<link rel="alternate" type="application/rss+xml" href="/f.xml">')], "url string, body string")
    c = discovery.feed_candidates(firms, pages)
    ordered = [r["url"] for r in c.orderBy("priority").collect()]
    assert ordered[:3] == ["https://a.com/f.xml", "https://a.com/p/feed", "https://a.com/feed"] and len(ordered) == 19
    assert discovery.select_firm(firms, "alpha").first()["name"] == "Alpha"
    with pytest.raises(ValueError):
        discovery.select_firm(firms, "alp")
    with pytest.raises(ValueError):
        discovery.select_firm(firms, "zzz")


def test_sink_document(spark):
    import json

    row = spark.createDataFrame([(1, " A title ", "", "T", "", "B", "why", 70, "u", True, "corporate_carveout", "signing", None, "pursue")], "ord long, title string, pe_firm string, target_company string, seller string, buyer string, reasoning string, fit int, url string, is_carveout boolean, deal_type string, stage string, published timestamp, recommended_action string")
    doc = json.loads(sink.document(sink.project(row), "db").first()["document"])["properties"]
    assert doc["Seller"]["rich_text"][0]["text"]["content"] == "N/A" and doc["Brief Status"]["select"]["name"] == "Queued" and "Date" not in doc
    assert sink.project(row.withColumn("title", F.lit("ab"))).count() == 0
    with pytest.raises(RuntimeError):
        sink.check_not_all_failed(spark.createDataFrame([("error",)], "outcome string"))


def test_state_json_is_tolerant(spark):
    assert tables.state_from_json(spark, "{not json")["seen"].count() == 0
    got = tables.state_from_json(spark, '{"version": 1, "seen": {"u": {"hash": "h", "first_seen": "2024-01-01"}}, "seen_deals": {"a|b|c": {"first_seen": "x"}}}')
    assert (got["seen"].count(), tuple(got["seen_deals"].first()), got["firm_errors"].count()) == (1, ("a", "b", "c", "x"), 0)
