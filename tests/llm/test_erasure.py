"""Erasure: files, filters and the cascade against plain loops."""

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wirelens.llm import erasure
from wirelens.llm.common import Scratch, shared_dir


def crc(v):
    return zlib.crc32(b"" if v is None else str(v).encode())


def ordered(row, columns):
    return [(row[c] is not None, row[c] if row[c] is not None else 0) for c in columns]


def plain_victims(tables):
    owner = {r["sale_id"]: r["client_id"] for r in tables["sales"]}
    clicks, by = collections.Counter(r["client_id"] for r in tables["clicks"]), collections.Counter()
    for r in tables["clients"]:
        if r["master_id"] is not None:
            by[r["master_id"]] += clicks[r["client_id"]]
    masters = {m for m in by if crc(m) % 100 == 0} | {min(by, key=lambda m: (-by[m], m))}
    clients = {r["client_id"] for r in tables["clients"] if r["master_id"] in masters} - {None}
    sales = {r["sale_id"] for r in tables["sales"] if r["client_id"] in clients} - {None}
    return owner, {"clients": ("master_id", masters), "clicks": ("client_id", clients), "sales": ("client_id", clients), "sale_lines": ("sale_id", sales)}


def test_query_equals_plain_loops(spark, sf):
    """Every file: its rows in order, its figures and its footer."""
    found = erasure.op11_cascading_erasure(spark, sf)
    assert found.columns == ["table_name", "file_no", "path", "columns", "n_rows", "n_erased", "cents", "ids_sha256", "rewritten"]
    got = {(r["table_name"], r["file_no"]): r for r in found.collect()}
    tables = {n: pq.read_table(f"{sf}/{n}.parquet").to_pylist() for n in erasure.MONEY}
    owner, victims = plain_victims(tables)
    want = 0
    for name, rows in tables.items():
        schema = pq.read_schema(f"{sf}/{name}.parquet").remove_metadata()
        whose = (lambda r: owner.get(r["sale_id"])) if name == "sale_lines" else (lambda r: r["client_id"])
        rows.sort(key=lambda r: (crc(whose(r)), ordered(r, schema.names)))
        size, (key, gone) = 1 + len(rows) // 150, victims[name]
        for at in range(0, len(rows), size):
            part = rows[at : at + size]
            stay = [r for r in part if r[key] is None or r[key] not in gone]
            if not stay:
                assert (name, at // size) not in got
                continue
            want += 1
            r = got[name, at // size]
            first, money = schema.names[0], erasure.MONEY[name]
            ids = ",".join("" if x[first] is None else str(x[first]) for x in stay)
            cents = sum(math.floor(100 * (x[money] or 0) + 0.5) for x in stay)
            assert tuple(r[3:]) == (",".join(schema.names), len(stay), len(part) - len(stay), cents, hashlib.sha256(ids.encode()).hexdigest(), len(stay) < len(part))
            held = pq.ParquetFile(r["path"])
            assert held.read().to_pylist() == stay and held.schema_arrow.remove_metadata() == schema
            stats = held.metadata.row_group(0).column(0).statistics
            known = [x[first] for x in stay if x[first] is not None]
            assert not known or (stats.min, stats.max) == (min(known), max(known))
    assert len(got) == want and any(r["rewritten"] for r in got.values()) and not all(r["rewritten"] for r in got.values())
    folder = os.path.dirname(os.path.dirname(next(iter(got.values()))["path"]))
    assert sum(len(f) for _, _, f in os.walk(folder)) == want


def test_filters_lose_no_key():
    r = np.random.default_rng(1)
    for n in (0, 1, 10, 5000):
        keys, others = r.integers(-(1 << 63), 1 << 63, (2, n))
        bits = erasure.make_filter(keys)
        assert erasure.hits(bits, keys).all()
        assert erasure.hits(bits, others).sum() <= 2


def small(spark, r, hot=False):
    """Two linked tables with nulls, repeated rows, a hot key and columns that are called like our own."""
    owners = [(None if i % 17 == 0 else i % 40, i, f"o{i}", i * 0.5) for i in range(200)] + [(3, 3, "again", None)] * 3
    things = [(None if i % 23 == 0 else 5 if hot and i % 3 else r.randrange(220), i % 90, "é" * (i % 5), None if i % 7 == 0 else i / 8) for i in range(900)]
    return spark.createDataFrame(owners, "path long, key long, row string, place double"), spark.createDataFrame(things, "key long, first long, h string, bits double")


STEPS = [erasure.Step("owners", "path", None, "key"), erasure.Step("things", "key", "owners")]


def laid(spark, scratch, folder, owners, things, parts=12):
    return {n: erasure.lay_out(df, df.columns, F.col("key"), folder, n, scratch, parts) for n, df in (("owners", owners), ("things", things))}


@pytest.mark.parametrize("hot", [False, True])
def test_names_nulls_and_hot_keys(spark, hot):
    scratch, r = Scratch(spark, "erasure-test"), random.Random(4)
    owners, things = small(spark, r, hot)
    folder = f"{shared_dir(spark)}/{os.path.basename(scratch.root)}-files"
    tables = laid(spark, scratch, folder, owners, things)
    seeds = spark.createDataFrame([(5,), (3,), (3,), (None,), (7777,)], "key long")
    out = erasure.erase(tables, STEPS, seeds, scratch).collect()
    gone = {x["key"] for x in owners.collect() if x["path"] in (3, 5)} - {None}
    for name, df, keep in (("owners", owners, lambda x: x["path"] not in (3, 5)), ("things", things, lambda x: x["key"] not in gone)):
        want = sorted((tuple(map(str, x)) for x in df.collect() if keep(x)))
        files = [x for x in out if x["table_name"] == name]
        got = sorted(tuple(map(str, x.values())) for f in files for x in pq.read_table(f["path"]).to_pylist())
        assert got == want and sum(f["n_rows"] for f in files) == len(want)
        assert all(f["rewritten"] == (f["n_erased"] > 0) for f in files)
        assert sorted(os.listdir(f"{folder}/{name}")) == sorted(os.path.basename(f["path"]) for f in files)


def test_files_stay_whole_until_all_are_rewritten(spark):
    """A job that ends after its tasks have written leaves every old file; the same job run again ends well."""
    scratch = Scratch(spark, "erasure-test")
    folder = f"{shared_dir(spark)}/{os.path.basename(scratch.root)}-files"
    tables = laid(spark, scratch, folder, *small(spark, random.Random(5)))
    before = {f[1]: open(f[1], "rb").read() for t in tables.values() for f in t.files}
    seeds = spark.createDataFrame([(3,)], "key long")

    def stop(phase):
        raise KeyboardInterrupt(phase)

    with pytest.raises(KeyboardInterrupt):
        erasure.erase(tables, STEPS, seeds, Scratch(spark, "erasure-test"), after=stop)
    assert {p: open(p, "rb").read() for p in before} == before
    out = erasure.erase(tables, STEPS, seeds, Scratch(spark, "erasure-test")).collect()
    assert any(r["rewritten"] for r in out)
    for r in out:
        assert r["rewritten"] == (open(r["path"], "rb").read() != before[r["path"]])


def test_empty_tables_and_no_victims(spark):
    scratch = Scratch(spark, "erasure-test")
    folder = f"{shared_dir(spark)}/{os.path.basename(scratch.root)}-files"
    owners, things = small(spark, random.Random(6))
    tables = laid(spark, scratch, folder, owners.where("false"), things)
    out = erasure.erase(tables, STEPS, spark.createDataFrame([(3,)], "key long"), scratch).collect()
    assert {r["table_name"] for r in out} == {"things"} and not any(r["rewritten"] for r in out) and sum(r["n_rows"] for r in out) == things.count()


def test_files_are_pieces_of_one_order(spark):
    scratch = Scratch(spark, "erasure-test")
    rows = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("x"), F.lit("y").alias("place"))
    t = erasure.lay_out(rows, rows.columns, F.lit(0), f"{shared_dir(spark)}/{os.path.basename(scratch.root)}-files", "t", scratch, 9)
    assert [f[2] for f in t.files] == [112] * 8 + [104]
    assert [x for f in t.files for x in pq.read_table(f[1]).column("x").to_pylist()] == list(range(1000))
