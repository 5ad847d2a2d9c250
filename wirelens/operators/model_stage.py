"""Rows through a language model in fixed batches: classify articles, qualify deals.

A provider is any callable (system, prompt) -> (reply, tokens in, tokens out).
Batches are numbered by the row order, rendered natively, sent once each, and
the replies are kept as a table before anything reads them, so that no plan
sends a batch twice.  A reply is parsed natively; its rows go back to the
inputs by position, with defaults for a missing tail.  One invalid row fails
its whole batch, which is then tried again and at last left to defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import model_json, scoring
from ..functions.constants import CLASSIFY_BATCH, MODEL_TRIES, QUALIFY_BATCH
from ..sources.journal import Journal, in_flight, key_of

Provider = Callable[[str, str], tuple[str, int, int]]

CLASSIFY_SYSTEM = """You read news items for sales of business units out of larger companies.
Answer with one JSON array, one object for each item in order, with the keys deal_type, stage, target_company, seller, buyer, confidence (0-100) and reasoning.
deal_type is corporate_carveout when a company sells a division to a private equity buyer, portco_carveout when a portfolio company sells one, and none otherwise.
It is none when the buyer is no private equity firm, when nothing has to be separated from a parent, or when no seller is named; so for secondary buyouts, take-privates, bolt-ons, exits, minority stakes, sales of a whole company, fund news, listings, asset transfers, self-contained subsidiaries and past deals.
stage is signing or closing, or null.
For example the item
1. "Harbor Capital signs deal to buy Orion's valve division"
is answered with
[{"deal_type": "corporate_carveout", "stage": "signing", "target_company": "valve division", "seller": "Orion", "buyer": "Harbor Capital", "confidence": 90, "reasoning": "a fund buys a division of a company"}]"""

QUALIFY_SYSTEM = """You score deals for work on separating the sold unit.
Answer with one JSON array, one object for each deal in order, with whole numbers from 0 to 100 for fit, separation_complexity, pe_buyer, size, sector and geography, and with pe_firm, recommended_action and reasoning.
fit weighs separation_complexity 30, pe_buyer 30, size 15, sector 15 and geography 10 percent. recommended_action is pursue from 65, monitor from 40, else discard."""


#: Rows of one numbering task, about, and the most tasks.
NUMBER_ROWS, NUMBER_TASKS = 50_000, 1000


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds batch and pos (both from 0) in row order; the order must be total.

    Rows are dealt over ranges of the order, whose bounds are fixed values
    that come from a bounded set of rows (those of the least hashes), numbered
    within each range, and each range starts where the ones before it end.
    """
    key = F.struct(*[F.col(c) for c in order])
    n_bounds = min(NUMBER_TASKS, df.count() // NUMBER_ROWS)
    part = F.lit(0)
    if n_bounds:
        types = dict(df.select(*order).dtypes)
        bounds = df.select(*order).orderBy(F.xxhash64(*order)).limit(n_bounds).collect()
        fixed = F.array(*[F.struct(*[F.lit(b[c]).cast(types[c]).alias(c) for c in order]) for b in bounds])
        part = F.size(F.filter(fixed, lambda b: b < key))
    dealt = df.withColumn("batch_part", part)
    numbered = dealt.withColumn("batch_local", F.row_number().over(W.partitionBy("batch_part").orderBy(*order)) - 1)
    starts = dealt.groupBy("batch_part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("batch_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    n = F.col("batch_first") + F.col("batch_local")
    joined = numbered.join(F.broadcast(starts.select("batch_part", before.alias("batch_first"))), "batch_part")
    return joined.withColumns({"batch": F.floor(n / size).cast("long"), "pos": (n % size).cast("int")}).drop("batch_part", "batch_local", "batch_first")


def article_line(pos: Column, title: Column, summary: Column) -> Column:
    head = F.concat((pos + 1).cast("string"), F.lit('. "'), F.coalesce(title, F.lit("")), F.lit('"'))
    return F.concat(head, F.when(F.coalesce(summary, F.lit("")) != "", F.concat(F.lit("\n   "), F.left(summary, F.lit(1000)))).otherwise(""))


def deal_line(pos: Column) -> Column:
    part = lambda name, c: F.concat(F.lit(f"\n   {name}: "), F.coalesce(F.col(c).cast("string"), F.lit("?")))
    notes = F.when(F.coalesce("reasoning", F.lit("")).contains("[Also:"), part("Reasoning", "reasoning")).otherwise("")
    return F.concat((pos + 1).cast("string"), F.lit('. "'), F.coalesce("title", F.lit("")), F.lit('"'), part("Type", "deal_type"), part("Target", "target_company"), part("Seller", "seller"), part("Buyer", "buyer"), part("Stage", "stage"), part("Confidence", "confidence"), notes, part("Summary", "summary"))


def prompts(df: DataFrame, line: Column, head: str) -> DataFrame:
    """A row for each batch: batch, n and prompt; a batch is of fixed size."""
    rows = F.array_sort(F.collect_list(F.struct("pos", line.alias("line"))))
    return df.groupBy("batch").agg(F.count("*").cast("int").alias("n"), F.concat(F.lit(head), F.array_join(F.transform(rows, lambda r: r["line"]), "\n")).alias("prompt"))


#: Calls of one task that are under way at once.
IN_FLIGHT = 4


def ask(asked: DataFrame, provider: Provider, system: str, accept: Callable[[str, int], bool], tries: int = MODEL_TRIES, journal: str | None = None, flights: int = IN_FLIGHT) -> DataFrame:
    """batch, reply (null after the last try), tokens_in, tokens_out.

    ``journal`` names a shared folder in which answered prompts are kept: a
    task that runs again, or a second run over the same folder, asks only for
    the others.  An answer is written down as it comes, whatever becomes of the
    rest of its task.  Of a prompt that is never answered well nothing is kept.
    """

    def one(row: tuple) -> tuple:
        batch, n, prompt = row
        spent = [0, 0]

        def call() -> dict | None:
            for _ in range(tries):
                try:
                    got, a, b = provider(system, prompt)
                except Exception:  # a provider's fault counts as a failed try
                    continue
                spent[0], spent[1] = spent[0] + a, spent[1] + b
                if accept(got, n):
                    return {"reply": got, "tokens_in": spent[0], "tokens_out": spent[1]}
            return None

        got = Journal(journal).once(key_of(system, int(n), prompt), call) if journal else call()
        return (batch, got["reply"], got["tokens_in"], got["tokens_out"]) if got else (batch, None, *spent)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = list(in_flight(one, part[["batch", "n", "prompt"]].itertuples(index=False, name=None), flights))
            yield pd.DataFrame(rows, columns=["batch", "reply", "tokens_in", "tokens_out"])

    return asked.mapInPandas(run, "batch long, reply string, tokens_in long, tokens_out long")


def parse_reply(text: str) -> list:
    """The outermost array of a reply, as the native expression finds it."""
    import json
    import re

    text = re.sub(r"```(?:json)?\s*", "", text).strip()
    at, depth = text.find("["), 0
    if at < 0:
        raise ValueError("no JSON array found")
    for i in range(at, len(text)):
        depth += {"[": 1, "]": -1}.get(text[i], 0)
        if depth == 0:
            return json.loads(text[at : i + 1])
    raise ValueError("unbalanced JSON array")


def _valid(names: tuple[str, ...], bounded: tuple[str, ...], texts: tuple[str, ...]) -> Callable[[str, int], bool]:
    def accept(reply: str, n: int) -> bool:
        try:
            rows = parse_reply(reply)
        except ValueError:
            return False
        for r in rows[:n]:
            if not isinstance(r, dict) or any(t in r and not isinstance(r[t], str) for t in texts):
                return False
            for name in names:
                v = r.get(name, 0)
                if isinstance(v, bool) or not isinstance(v, (int, float)) or v != int(v) or name in bounded and not 0 <= v <= 100:
                    return False
        return True

    return accept


accept_classified = _valid(("confidence",), ("confidence",), ("target_company", "seller", "buyer", "reasoning"))
accept_qualified = _valid(("fit", "separation_complexity", "pe_buyer", "size", "sector", "geography"), ("fit",), ("pe_firm", "recommended_action", "reasoning"))


def with_answers(df: DataFrame, replies: DataFrame, schema: str) -> DataFrame:
    """Adds answer: the reply's object at the row's position, null where it is missing."""
    parsed = replies.select("batch", F.from_json(model_json.json_array(F.col("reply")), schema).alias("answers"))
    return df.join(parsed, "batch", "left").withColumn("answer", F.get("answers", F.col("pos"))).drop("answers")


def classified(df: DataFrame) -> DataFrame:
    """Alert columns from answer, with defaults."""
    a = F.col("answer")
    kind = model_json.deal_type(a["deal_type"])
    text = lambda n: F.coalesce(a[n], F.lit(""))
    return df.withColumns(
        {"deal_type": kind, "is_carveout": kind.isNotNull(), "stage": model_json.stage(a["stage"]), "target_company": text("target_company"), "seller": text("seller"),
         "buyer": text("buyer"), "reasoning": text("reasoning"), "confidence": F.coalesce(model_json.whole(a["confidence"]), F.lit(0))}
    ).drop("answer", "batch", "pos")


def qualified(df: DataFrame) -> DataFrame:
    """Scores from answer, capped; without an answer all are 0 and the action is discard."""
    a = F.col("answer")
    num = lambda n: F.coalesce(model_json.whole(a[n]), F.lit(0))
    fit, action = scoring.capped(num("fit"), F.coalesce(a["recommended_action"], F.lit("discard")), num("pe_buyer"), num("separation_complexity"))
    return df.withColumns({"fit": fit, **{n: num(n) for n in ("separation_complexity", "pe_buyer", "size", "sector", "geography")}, "pe_firm": F.coalesce(a["pe_firm"], F.lit("")), "recommended_action": action}).drop("answer", "batch", "pos")


def classify(articles: DataFrame, provider: Provider | None, order: list[str], keep: Callable[[DataFrame, str], DataFrame], journal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(alerts, usage); without a provider all rows get defaults.  ``keep`` writes a table and reads it back."""
    rows = keep(batches(articles, order, CLASSIFY_BATCH), "classify-in")
    line = article_line(F.col("pos"), F.col("title"), F.col("summary"))
    asked = prompts(rows, line, "Classify these items:\n")
    replies = keep(ask(asked, provider, CLASSIFY_SYSTEM, accept_classified, journal=journal) if provider else asked.select("batch", F.lit(None).cast("string").alias("reply"), F.lit(0).cast("long").alias("tokens_in"), F.lit(0).cast("long").alias("tokens_out")), "classify-out")
    return classified(with_answers(rows, replies, model_json.ANSWER)), replies


def qualify(alerts: DataFrame, provider: Provider | None, order: list[str], keep: Callable[[DataFrame, str], DataFrame], journal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(qualified alerts, usage)."""
    rows = keep(batches(alerts, order, QUALIFY_BATCH), "qualify-in")
    asked = prompts(rows, deal_line(F.col("pos")), "Score these deals:\n")
    replies = keep(ask(asked, provider, QUALIFY_SYSTEM, accept_qualified, journal=journal) if provider else asked.select("batch", F.lit(None).cast("string").alias("reply"), F.lit(0).cast("long").alias("tokens_in"), F.lit(0).cast("long").alias("tokens_out")), "qualify-out")
    return qualified(with_answers(rows, replies, model_json.SCORED)), replies


def usage(replies: DataFrame) -> DataFrame:
    """Tokens and cost of a stage."""
    t = replies.agg(F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"))
    return t.withColumn("cost", scoring.cost(F.col("tokens_in"), F.col("tokens_out")))
