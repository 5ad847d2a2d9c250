"""State as versions: only changed parts are rewritten, and a crash leaves a readable one."""

import os

import pytest
from pyspark.sql import functions as F

from wirelens.operators import state
from wirelens.plans import scan
from wirelens.sources import tables
from wirelens.sources.versions import PARTS, Versions


def urls(spark, n, day, start=0):
    return spark.range(start, start + n).select(F.concat(F.lit("https://x/"), "id").alias("url"), F.lit("h").alias("hash"), F.lit(f"{day} 08:00:00").alias("first_seen"))


def files(root, table):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/data/{table}") for f in fs if f.endswith(".parquet")}


def first_state(spark, root):
    seen = urls(spark, 3000, "2024-01-20").unionAll(urls(spark, 3000, "2024-01-30", 3000))
    errors = spark.range(200).selectExpr("concat('f', id) firm_name", "'404' last_error", "'2024-01-30' last_error_date", "1 consecutive_404s", "false needs_url_update", "false prefer_render")
    tables.write_state(scan.fresh_state(spark) | {"seen": seen, "firm_errors": errors}, root)


def test_new_urls_rewrite_their_own_part(spark, tmp_path):
    root = str(tmp_path / "s")
    first_state(spark, root)
    before, errors = files(root, "seen"), files(root, "firm_errors")
    old = tables.read_state(spark, root)
    now = F.lit("2024-01-31 12:00:00").cast("timestamp")
    seen = state.mark_seen(state.prune(old["seen"], now), urls(spark, 1000, "x", 5500), now)
    one = old["firm_errors"].withColumn("consecutive_404s", F.when(F.col("firm_name") == "f7", 2).otherwise(F.col("consecutive_404s")))
    made = Versions(spark, root).write(old | {"seen": seen, "firm_errors": one})
    assert made["rewritten"]["seen"] == ["2024-01-31"] and len(made["rewritten"]["firm_errors"]) == 1 and made["rewritten"]["seen_deals"] == []
    assert before.items() <= files(root, "seen").items() and errors.items() <= files(root, "firm_errors").items()
    again = tables.read_state(spark, root)
    assert (again["seen"].count(), again["seen"].select("url").distinct().count(), again["firm_errors"].count()) == (6500, 6500, 200)
    assert again["firm_errors"].where("consecutive_404s = 2").collect()[0]["firm_name"] == "f7"
    # a day that leaves takes its part with it, and its files go once no kept version lists them
    late = F.lit("2024-02-04 12:00:00").cast("timestamp")
    for _ in range(2):
        made = Versions(spark, root).write({"seen": state.prune(tables.read_state(spark, root)["seen"], late)})
        assert made["rewritten"]["seen"] == [] and set(made["tables"]["seen"]) == {"2024-01-30", "2024-01-31"}
    assert not [f for f in files(root, "seen") if "2024-01-20" in f] and len(Versions(spark, root).numbers()) == 2
    assert tables.read_state(spark, root)["firm_errors"].count() == 200  # tables that are not given stay


@pytest.mark.parametrize("step", ["_fingerprints", "_commit", "rename", "_clear"])
def test_a_crash_leaves_a_readable_version(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "s")
    tables.write_state({"seen": urls(spark, 10, "2024-01-30")}, root)

    def crash(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "rename":
            def torn(self, number, made):
                out = self.fs.create(self._path(f"versions/.next-{number}"), True)
                out.write(bytearray(b'{"num'))
                out.close()
                crash()

            m.setattr(Versions, "_commit", torn)
        else:
            m.setattr(Versions, step, crash)
        with pytest.raises(KeyboardInterrupt):
            tables.write_state({"seen": urls(spark, 25, "2024-01-31")}, root)
    assert tables.read_state(spark, root)["seen"].count() == (25 if step == "_clear" else 10)
    tables.write_state({"seen": urls(spark, 30, "2024-01-31")}, root)
    assert tables.read_state(spark, root)["seen"].count() == 30


def test_undated_rows_nulls_and_a_second_writer(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = spark.createDataFrame([("u", None, None), (None, "h", "soon"), ("u", None, None), ("v", "", "2024-01-30T08:00:00")], "url string, hash string, first_seen string")
    tables.write_state({"seen": rows}, root, "2024-01-31")
    assert sorted(map(str, tables.read_state(spark, root)["seen"].collect())) == sorted(map(str, rows.collect()))
    assert tables.last_run(spark, root) == "2024-01-31" and tables.last_run(spark, str(tmp_path / "none")) is None
    # null and empty are told apart
    assert Versions(spark, root).write({"seen": rows.fillna("", ["hash"])})["rewritten"]["seen"] == ["undated"]
    v = Versions(spark, root)
    with pytest.raises(RuntimeError, match="another run"):
        v._commit(2, {})
    assert PARTS > 1 and v.read(1)["seen"].where("hash is null").count() == 2
