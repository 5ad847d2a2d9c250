"""Keyed streaming state: streaks, counts, and keys that leave the store."""

import time

from wirelens.streaming import jobs, keyed

LOG = "firm_name string, seq int, outcome string"


def rounds(spark, tmp_path, make, schema, mode="update"):
    """A function that lands rows, runs the stream once over them and gives the batch's rows."""
    src, got = str(tmp_path / "in"), []

    def run(rows):
        got.clear()
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        df = make(spark.readStream.schema(schema).parquet(src))
        jobs.run_available(df, str(tmp_path / "ck"), lambda b, n: got.extend(b.collect()), mode).awaitTermination()
        return sorted(got, key=str)

    return run


def stored(spark, tmp_path, name):
    return spark.read.format("statestore").option("stateVarName", name).load(str(tmp_path / "ck"))


def test_streaks_by_seq_with_replays_and_gaps(spark, tmp_path):
    run = rounds(spark, tmp_path, keyed.error_state, LOG)
    one = run([("f", 2, "404"), ("f", 1, "ok"), ("g", 1, "403"), ("f", 3, "404"), ("h", None, "404"), ("h", 1, None), (None, 1, "404")])
    assert {r["firm_name"]: (r["consecutive_404s"], r["prefer_render"], r["last_outcome"], r["outcomes"]) for r in one} == {
        "f": (2, False, "404", {"ok": 1, "404": 2}), "g": (0, True, "403", {"403": 1}), None: (1, False, "404", {"404": 1}),
    }
    # a replay and a late copy change nothing; the third miss flags, a success ends the streak alone
    assert run([("f", 3, "404"), ("f", 1, "404")]) == []
    assert [(r["consecutive_404s"], r["needs_url_update"]) for r in run([("f", 4, "404"), ("f", 4, "404")])] == [(3, True)]
    last = run([("f", 5, "ok"), ("g", 2, "timeout")])
    assert [(r["firm_name"], r["consecutive_404s"], r["needs_url_update"], r["prefer_render"]) for r in last] == [("f", 0, True, False), ("g", 0, False, True)]
    assert {r["key"]["firm_name"] for r in stored(spark, tmp_path, "streak").collect()} == {"f", "g", None}


def test_an_idle_source_leaves_the_store(spark, tmp_path):
    run = rounds(spark, tmp_path, lambda df: keyed.error_state(df, 4000), LOG)
    run([("f", 1, "404"), ("g", 1, "404")])
    assert stored(spark, tmp_path, "streak").count() == 2
    time.sleep(4.5)
    got = run([("g", 2, "404")])
    idle = {r["firm_name"] for r in got if r["last_outcome"] == keyed.IDLE}
    assert "f" in idle
    assert {r["key"]["firm_name"] for r in stored(spark, tmp_path, "streak").collect()} <= {"g"}
    time.sleep(0.1)
    # what comes back starts anew
    assert [(r["consecutive_404s"], r["outcomes"]) for r in run([("f", 2, "404")]) if r["firm_name"] == "f"] == [(1, {"404": 1})]


def test_late_repeats_are_absorbed_and_old_urls_leave(spark, tmp_path):
    schema = "url string, fetched_at string"
    run = rounds(spark, tmp_path, lambda df: keyed.new_rows(df, ttl_ms=5000), schema)
    assert [r["url"] for r in run([("u", "2024-01-31"), ("u", "2024-01-31"), ("v", "2024-01-31"), (None, "x")])] == ["u", "v"]
    assert run([("u", "1999-01-01"), ("v", "2030-01-01")]) == []  # dates of any age
    time.sleep(5.5)
    assert [r["url"] for r in run([("u", "2024-01-31")])] == ["u"]
    assert {r["key"]["url"] for r in stored(spark, tmp_path, "known").collect()} == {"u"}


def test_the_session_keeps_its_store(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    rounds(spark, tmp_path, keyed.error_state, LOG)([("f", 1, "ok")])
    assert spark.conf.get(name) == before
