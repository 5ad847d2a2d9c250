"""Sink and model calls: each answered one is made once, whatever fails between."""

import collections
import json
import os

import pytest

from wirelens.operators import model_stage
from wirelens.sources import journal, outlet


class Counting:
    """Takes documents and notes each call in a file; dies, as a lost executor does, at the calls given."""

    def __init__(self, path, deaths=()):
        self.path, self.deaths = str(path), set(deaths)

    def calls(self):
        return collections.Counter(open(self.path).read().split("\n")[:-1]) if os.path.exists(self.path) else collections.Counter()

    def note(self, what):
        with open(self.path, "a") as f:
            f.write(what + "\n")

    def __call__(self, document):
        if document in self.deaths:
            self.note(f"died at {document}")
            raise SystemExit("lost")
        self.note(document)
        return None if document == "refused" else f"page of {document}"


def documents(spark, n=12, extra=()):
    return spark.createDataFrame([(i, f"d{i}") for i in range(n)] + list(extra), "ord long, document string").repartition(3)


def test_every_document_is_posted_once(spark, tmp_path):
    post = Counting(tmp_path / "calls")
    docs = documents(spark, extra=[(50, "refused"), (51, "d3")])
    got = sorted(map(tuple, outlet.deliver(docs, post, 0, str(tmp_path / "j")).collect()))
    assert got == sorted([(i, f"page of d{i}", "written") for i in range(12)] + [(50, None, "error"), (51, "page of d3", "written")])
    assert post.calls() == {**{f"d{i}": 1 for i in range(12)}, "d3": 2, "refused": 1}
    # the same again: only what was refused is tried once more
    outlet.deliver(docs, post, 0, str(tmp_path / "j")).collect()
    assert post.calls() == {**{f"d{i}": 1 for i in range(12)}, "d3": 2, "refused": 2}


def test_a_task_that_dies_half_way_posts_nothing_twice(spark, tmp_path):
    docs, path = documents(spark), tmp_path / "calls"
    with pytest.raises(Exception, match="lost"):
        outlet.deliver(docs, Counting(path, ["d7"]), 0, str(tmp_path / "j"))
    before = Counting(path).calls()
    assert before["died at d7"] == 1 and sum(before.values()) > 1
    got = outlet.deliver(docs, Counting(path), 0, str(tmp_path / "j")).collect()
    assert {r["outcome"] for r in got} == {"written"} and len(got) == 12
    after = Counting(path).calls()
    assert all(after[f"d{i}"] == 1 for i in range(12))
    ends = [json.loads(p.read_text()) for p in (tmp_path / "j-runs").glob("*/*.json")]
    assert sorted(e["end"] for e in ends) == ["aborted", "committed"]
    assert next(e for e in ends if e["end"] == "committed")["known"] == sum(v for k, v in before.items() if not k.startswith("died"))


def test_documents_are_not_sent_by_one_task(spark, tmp_path):
    seen = Counting(tmp_path / "calls")

    def post(document):
        from pyspark import TaskContext

        seen.note(str(TaskContext.get().partitionId()))
        return document

    outlet.deliver(documents(spark, 60), post, 0, str(tmp_path / "j")).collect()
    assert len(seen.calls()) > 1 and sum(seen.calls().values()) == 60


class Model:
    """Answers every prompt, but fails at the first call of each task that gets so far."""

    def __init__(self, path, fail_at=None):
        self.count, self.fail_at = Counting(path), fail_at

    def __call__(self, system, prompt):
        if self.fail_at and prompt == self.fail_at:
            raise SystemExit("lost")
        self.count.note(prompt)
        return json.dumps([{"confidence": 50}]), 10, 2


def prompts(spark, n=9):
    return spark.createDataFrame([(i, 1, f"p{i}") for i in range(n)], "batch long, n int, prompt string").coalesce(1)


def test_answered_prompts_are_asked_once(spark, tmp_path):
    ask = lambda model: model_stage.ask(prompts(spark), model, "s", model_stage.accept_classified, journal=str(tmp_path / "j"), flights=2)
    with pytest.raises(Exception, match="lost"):
        ask(Model(tmp_path / "calls", "p6")).collect()
    assert sum(Counting(tmp_path / "calls").calls().values()) >= 5
    got = sorted(ask(Model(tmp_path / "calls")).collect())
    assert [tuple(r) for r in got] == [(i, '[{"confidence": 50}]', 10, 2) for i in range(9)]
    assert Counting(tmp_path / "calls").calls() == {f"p{i}": 1 for i in range(9)}


def test_bad_answers_are_not_kept(spark, tmp_path):
    calls = Counting(tmp_path / "calls")

    def model(system, prompt):
        calls.note(prompt)
        return "no array", 1, 1

    for k in (1, 2):
        got = model_stage.ask(prompts(spark, 2), model, "s", model_stage.accept_classified, tries=3, journal=str(tmp_path / "j")).collect()
        assert [(r["reply"], r["tokens_in"]) for r in got] == [(None, 3), (None, 3)] and sum(calls.calls().values()) == 6 * k


def test_journal_and_flights(tmp_path):
    j = journal.Journal(str(tmp_path / "j"))
    assert j.get("ab") is None and j.once("ab", lambda: None) is None
    assert j.once("ab", lambda: {"x": 1}) == {"x": 1} == j.once("ab", lambda: {"x": 2})
    begun = []
    flights = journal.in_flight(lambda x: begun.append(x) or x * x, range(10), 3)
    assert next(flights) == 0 and len(begun) <= 4
    assert list(flights) == [x * x for x in range(1, 10)]
