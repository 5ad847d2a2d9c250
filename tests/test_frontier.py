"""Probing asks no more than a loop would; one deadline and a gap between a host's requests hold for all tasks."""

import time

from pyspark.sql import functions as F

from wirelens.functions.constants import FEED_PATHS, PRESS_PATHS
from wirelens.plans import frontier, gather
from wirelens.plans.scan import Workspace
from wirelens.sources import fetch

NEWS = "".join(f'<a href="/news/{i}">n</a>' for i in range(3))
FEED = '<rss version="2.0"><channel><title>f</title><item><title>x</title><link>https://a/1</link></item></channel></rss>'


class Site:
    """Serves paths of hosts and notes every request with its time."""

    def __init__(self, path, pages, gone=(), delay=0.0):
        self.path, self.pages, self.gone, self.delay = str(path), pages, gone, delay

    def __call__(self, url, head, timeout, verify):
        with open(self.path, "a") as f:
            f.write(f"{time.time()} {url}\n")
        time.sleep(self.delay)
        if any(g in url for g in self.gone):
            raise TimeoutError
        return (200, self.pages[url]) if url in self.pages else (404, "")

    def asked(self):
        return [(float(t), u) for t, u in (line.split() for line in open(self.path))]


def firms(spark, rows):
    return spark.createDataFrame(rows, "name string, domain string, feed_url string, press_url string")


def test_press_probing_stops_where_a_loop_does(spark, tmp_path):
    at = {"a": 0, "b": 2, "c": 5}
    pages = {f"https://{n}.com{PRESS_PATHS[k]}": NEWS for n, k in at.items()} | {f"https://b.com{PRESS_PATHS[7]}": NEWS, f"https://none.com{PRESS_PATHS[1]}": "<a href='/news/1'>one</a>"}
    site = Site(tmp_path / "asked", pages, gone=(f"lost.com{PRESS_PATHS[3]}",))
    rows = firms(spark, [(n, f"{n}.com", None, None) for n in (*at, "lost", "none")] + [("nowhere", None, None, None)])
    found = gather.find_press_pages(rows, Workspace(spark, str(tmp_path / "w")), gather.Web(site)).collect()
    assert {r["name"]: r["url"] for r in found} == {n: f"https://{n}.com{PRESS_PATHS[k]}" for n, k in at.items()}
    asked = [u for _, u in site.asked()]
    paths = {n: PRESS_PATHS[: k + 1] for n, k in at.items()} | {"lost": PRESS_PATHS[:4], "none": PRESS_PATHS}
    assert sorted(asked) == sorted(f"https://{n}.com{p}" for n, ps in paths.items() for p in ps)


def test_feeds_are_looked_for_in_order(spark, tmp_path):
    link = "<link rel='alternate' type='application/rss+xml' href='/f.xml'>"
    pages = {
        "https://home.com": link, "https://home.com/f.xml": FEED, "https://press.com": "", "https://press.com/p": link, "https://press.com/f.xml": FEED,
        "https://own.com/p/feed": FEED, f"https://path.com{FEED_PATHS[1]}": FEED,
    }
    site = Site(tmp_path / "asked", pages)
    rows = firms(spark, [(n, f"{n}.com", None, f"https://{n}.com/p") for n in ("home", "press", "own", "path")])
    found = gather.find_feeds(rows, Workspace(spark, str(tmp_path / "w")), gather.Web(site)).collect()
    assert {r["name"]: r["url"] for r in found} == {"home": "https://home.com/f.xml", "press": "https://press.com/f.xml", "own": "https://own.com/p/feed", "path": f"https://path.com{FEED_PATHS[1]}"}
    asked = [u for _, u in site.asked()]
    assert sorted(asked) == sorted([*(f"https://{n}.com" for n in ("home", "press", "own", "path")), "https://home.com/f.xml", *(f"https://{n}.com/p" for n in ("press", "own", "path")), "https://press.com/f.xml", "https://own.com/p/feed", "https://path.com/p/feed", *(f"https://path.com{p}" for p in FEED_PATHS[:2])])


def test_no_candidates(spark, tmp_path):
    none = spark.createDataFrame([], "name string, priority int, url string")
    assert frontier.probe(none, lambda urls, carry: urls, F.lit(True), Workspace(spark, str(tmp_path)).keep, "x").count() == 0


def test_one_deadline_for_all_tasks(spark, tmp_path):
    """Many tasks of slow urls: the run ends with the budget and one request, and says what is left."""
    site = Site(tmp_path / "asked", {}, delay=0.3)
    urls = spark.createDataFrame([(f"https://h{i}.com/{i % 3}", f"f{i}") for i in range(200)], "url string, firm_name string")
    fetch.fetch(urls.limit(4), site, gap=0).collect()  # starts the workers
    began = time.time()
    log = fetch.fetch(urls, site, budget=2, gap=0).collect()
    assert time.time() - began < 8
    late = [r for r in log if r["error_type"] == fetch.UNFINISHED]
    assert len(log) == 200 and 0 < len(late) < 200
    assert all(t < began + 2.1 for t, _ in site.asked())


def test_hosts_take_turns(spark, tmp_path):
    site = Site(tmp_path / "asked", {})
    urls = spark.createDataFrame([(f"https://{h}.com/{i}", h) for h in ("a", "b", "c") for i in range(4)], "url string, firm_name string")
    assert fetch.fetch(urls, site, gap=0.3).count() == 12
    times = {}
    for t, u in site.asked():
        times.setdefault(u.split("/")[2], []).append(t)
    assert all(b - a >= 0.29 for ts in times.values() for a, b in zip(ts, ts[1:], strict=False)) and all(len(ts) == 4 for ts in times.values())
