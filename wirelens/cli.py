"""Command line: scan, lookback, backtest, discover, feedback, reset-state, import-state."""

from __future__ import annotations

import argparse
import glob
import sys
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.constants import SINK_PAUSE
from .operators import discovery, filters, sink, state
from .plans import gather, scan as plans
from .sources import outlet, providers, readers, tables


def session() -> SparkSession:
    return SparkSession.builder.appName("wirelens").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wirelens")
    p.add_argument("--targets", default="targets.yml")
    p.add_argument("--state", default="state")
    p.add_argument("--work", help="folder of a run's tables, which driver and executors share; below spark.checkpoint.dir if left out")
    p.add_argument("--provider", help="language model: module:function or the address of a chat service")
    p.add_argument("--model", default="", help="the service's model")
    p.add_argument("--renderer", help="module:function that renders a page")
    p.add_argument("--unverified", action="store_true", help="try a host with a bad certificate once without verification")
    sub = p.add_subparsers(dest="command")
    s = sub.add_parser("scan")
    s.add_argument("--hours", type=int, default=24)
    s.add_argument("--skip-sink", "--skip-notion", dest="skip_sink", action="store_true")
    s.add_argument("--sink", help="module:function or the address of a service; a folder of JSON rows if left out")
    s.add_argument("--skip-scraper", action="store_true")
    s.add_argument("--skip-fetch", action="store_true")
    d = sub.add_parser("discover")
    d.add_argument("--update", action="store_true")
    d.add_argument("--firm")
    sub.add_parser("backtest")
    sub.add_parser("reset-state")
    sub.add_parser("import-state").add_argument("file", help="a state in its JSON form")
    back = sub.add_parser("lookback")
    back.add_argument("--days", type=int, default=30)
    back.add_argument("--output", default="lookback_results.csv")
    back.add_argument("--skip-fetch", action="store_true")
    f = sub.add_parser("feedback")
    f.add_argument("--pages", default="verdicts/*.json", help="saved answer pages, or the address of the review database's query service")
    return p


def web(a: argparse.Namespace) -> gather.Web:
    return gather.Web(render=providers.load(a.renderer) if a.renderer else None, unverified=a.unverified)


def workspace(spark: SparkSession, path: str | None) -> plans.Workspace:
    if not path:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise ValueError("--work must name a folder that driver and executors share")
        path = f"{shared.rstrip('/')}/wirelens-news" if shared else "work"
    return plans.Workspace(spark, path, f"{path}/calls")


def sender(a: argparse.Namespace, work: plans.Workspace):
    """What takes the documents: the sink that is named, or a folder that takes them all."""
    post = providers.sink(a.sink)
    if post:
        return lambda documents: outlet.deliver(documents, post, SINK_PAUSE, f"{work.root}/delivered")

    def to_folder(documents):
        documents.write.mode("append").json(f"{work.root}/sink")
        return documents.selectExpr("ord", "cast(ord as string) as page_id", "'written' as outcome")

    return to_folder


def discover(spark: SparkSession, a: argparse.Namespace, work: plans.Workspace, net: gather.Web) -> None:
    firms = tables.firms(spark, a.targets)
    chosen = discovery.select_firm(firms, a.firm) if a.firm else firms.where("feed_url is null")
    found = work.keep(gather.find_feeds(chosen, work, net), "found")
    discovery.counts(chosen, found).show()
    if a.update:
        tables.write_firms(discovery.fill_urls(firms, found, "feed_url", overwrite=bool(a.firm)), a.targets)
        old = tables.read_state(spark, a.state)
        names = [r[0] for r in found.select("name").collect()]  # firms of a file that people edit
        tables.write_state(old | {"firm_errors": work.keep(state.clear_flag(old["firm_errors"], "firm_name", names), "errors")}, a.state)


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    if not a.command:
        parser().print_help()
        return 1
    spark = session()
    now = F.lit(spark.sql("select current_timestamp()").first()[0]).cast("timestamp")
    if a.command == "reset-state":
        plans.reset(spark, a.state)
        return 0
    if a.command == "import-state":
        with open(a.file, encoding="utf-8") as f:
            tables.write_state(tables.state_from_json(spark, f.read()), a.state)
        return 0
    if a.command == "feedback":
        if a.pages.startswith(("http://", "https://")):
            rows = readers.reviews(spark, providers.asker(a.pages), f"{workspace(spark, a.work).root}/review-{uuid.uuid4().hex}")
        else:
            rows = tables.verdicts(spark, [open(p, encoding="utf-8").read() for p in sorted(glob.glob(a.pages))])
        print(plans.accuracy_report(rows))
        return 0
    work, net = workspace(spark, a.work), web(a)
    if a.command == "discover":
        discover(spark, a, work, net)
        return 0
    model = providers.model(a.provider, a.model)
    firms = tables.firms(spark, a.targets)
    old = tables.read_state(spark, a.state)
    if a.command == "backtest":
        got = gather.gather(spark, firms, old["firm_errors"], work, net, scrape=False, flags=False)
        for r in plans.backtest(got.inputs.feeds, now, work, model).toLocalIterator():
            print(f"{r['deal_type']} ({r['n']})", *r["lines"], sep="\n  ")
        return 0
    got = gather.gather(spark, firms, old["firm_errors"], work, net, scrape=not getattr(a, "skip_scraper", False))
    got.inputs.bodies = None if a.skip_fetch else gather.bodies(work, net)
    late = [r[0] for r in got.unfinished.orderBy("firm_name").collect()]  # firms of a file that people edit
    if late:
        print("not finished:", ", ".join(late))
    if a.command == "lookback":
        out = plans.lookback(got.inputs, now, work, model, days=a.days)
        out.coalesce(1).write.mode("overwrite").option("header", True).csv(a.output)
        return 0
    if not got.found.isEmpty():
        tables.write_firms(discovery.fill_urls(firms, got.found, "press_url"), a.targets)
    send = None if a.skip_sink else sender(a, work)
    done = plans.scan(got.inputs, old, now, work, model, model, hours=a.hours, dry_run=a.skip_sink, log=got.log, send=send)
    done.counts.orderBy("place").select("stage", "n").show()
    filters.action_counts(done.actionable).show()
    flagged = [r[0] for r in state.flagged(done.state["firm_errors"], "firm_name").orderBy("firm_name").collect()]
    if flagged:
        print("need a new address:", ", ".join(flagged))
    if not a.skip_sink:
        sink.outcomes(done.written).show()
        tables.write_state(done.state, a.state)
    for name, used in done.usage.items():
        u = used.first()
        print(f"{name}: {u['tokens_in']} tokens in, {u['tokens_out']} out, ${u['cost']:.2f}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
