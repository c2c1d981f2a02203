"""Keyed cell store, counts over runs, storage modules: repeated, interrupted and concurrent runs."""

import json
import os
import subprocess
import sys
import threading
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rrspark.cli import main
from rrspark.operators.cells import event_generator, map_event_generator
from rrspark.session import arrow_filesystem, scratch_path
from rrspark.sinks.files import store_json_run, write_cells
from rrspark.sinks.module import CELLS, ParquetFactory, store_records
from rrspark.sinks.store import CellStore
from rrspark.streaming.stream import run_sink, start_cell_store

CELL = "table_name string, row string, cf string, cq string, value string"


def cells_of(spark, rows, table="t.x/y"):
    return spark.createDataFrame([(table, r, "cf", "cq", v) for r, v in rows], CELL)


def held(store, table=None):
    return {(r["table_name"], r["row"]): r["value"] for r in store.cells(table).collect()}


def counted(store):
    return {r["row"]: r["n"] for r in store.counts().collect()}


def test_sets_stay_side_by_side_and_repeats_change_nothing(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=4)
    a, b = cells_of(spark, [("r1", "1"), ("r2", "1"), ("r1", "1")]), cells_of(spark, [("r2", "1"), ("r3", "1")], "other")
    for compact in (False, True):
        assert store.add(a, "a") is not compact and store.add(b, "b/1") is not compact
        assert not store.add(a, "a")
        if compact:
            store.compact()
            assert not store.add(a, "a")  # also when it is in the base
        assert held(store) == {("t.x/y", "r1"): "1", ("t.x/y", "r2"): "1", ("other", "r2"): "1", ("other", "r3"): "1"}
        assert held(store, "other").keys() == {("other", "r2"), ("other", "r3")} and held(store, "none") == {}
        assert sorted((r["table_name"], r["row"], r["n"]) for r in store.counts().collect()) == [
            ("other", "r2", 1), ("other", "r3", 1), ("t.x/y", "r1", 2), ("t.x/y", "r2", 1)]
    assert CellStore(spark, store.path, buckets=99).buckets == 4


def test_counts_add_up_and_the_latest_run_wins(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=4)
    store.add(cells_of(spark, [("k", "old"), ("only", "x")]), "1")
    store.compact()
    store.add(cells_of(spark, [("k", "new"), ("k", "new"), ("k", "mew")]), "2")
    store.add(cells_of(spark, [("k", "newer")]), "3")
    for _ in range(2):
        assert held(store) == {("t.x/y", "k"): "newer", ("t.x/y", "only"): "x"} and counted(store) == {"k": 5, "only": 1}
        store.compact()
    assert store.compact() == 0


def test_a_compaction_rewrites_only_the_buckets_touched(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=16)
    store.add(cells_of(spark, [(f"r{i}", "1") for i in range(400)]), "all")
    assert store.compact() == 16
    before = store._base()[1]["parts"]
    store.add(cells_of(spark, [("r7", "2")]), "one")
    assert store.compact() == 1
    after = store._base()[1]["parts"]
    assert sum(before[p] != after[p] for p in before) == 1 and len(store._base()[1]["parts"]) == 16
    assert len(store.folder.names("data")) == 4
    assert store.clean() == 0  # not yet: a reader may hold them
    assert store.clean(older_than_s=0) == 2  # the folders of the two runs; 15 buckets of the first compaction are in use
    assert len(held(store)) == 400 and held(store)[("t.x/y", "r7")] == "2"
    rows = spark.read.parquet(f"{store.path}/{next(iter(after.values()))}").collect()
    assert [r["row"] for r in rows] == sorted(r["row"] for r in rows)


def test_a_run_that_dies_leaves_no_cell(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=2)
    store.add(cells_of(spark, [("r", "1")]), "good")

    def lost():
        raise OSError("the driver goes before the run is committed")

    with pytest.raises(OSError):
        store.add(cells_of(spark, [("r", "2"), ("s", "2")]), "bad", counters=lost)
    assert held(store) == {("t.x/y", "r"): "1"} and not store.has("bad") and store.clean(0) == 1
    assert store.add(cells_of(spark, [("s", "3")]), "bad") and counted(store) == {"r": 1, "s": 1}


def test_a_compaction_that_dies_after_its_manifest_counts_once(spark, monkeypatch):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=2)
    store.add(cells_of(spark, [("r", "1")]), "a")
    monkeypatch.setattr(store, "_retire", lambda names: None)
    store.compact()
    monkeypatch.undo()
    assert counted(store) == {"r": 1} and not store.add(cells_of(spark, [("r", "1")]), "a")
    store.add(cells_of(spark, [("r", "1")]), "b")
    store.compact()
    store.compact()
    assert counted(store) == {"r": 2} and store.folder.names("pending") == []


def test_runs_side_by_side(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=2)
    sets = [cells_of(spark, [("hot", "1"), (f"r{i}", "1")]) for i in range(4)]
    threads = [threading.Thread(target=store.add, args=(c, f"run{i}")) for i, c in enumerate(sets)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert counted(store) == {"hot": 4, "r0": 1, "r1": 1, "r2": 1, "r3": 1}


def test_empty_runs_and_stores(spark):
    store = CellStore(spark, scratch_path(spark, "store"))
    assert held(store) == {} and store.compact() == 0
    assert store.add(cells_of(spark, [("r", "1")]).where("false"), "none") and not store.add(cells_of(spark, [("r", "1")]), "none")
    assert held(store) == {} and store.compact() == 0 and counted(store) == {}


def test_a_hot_key_takes_one_row_a_task(spark):
    store = CellStore(spark, scratch_path(spark, "store"), buckets=4)
    rows = spark.range(90_000, numPartitions=6).select(
        F.lit("t").alias("table_name"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row"),
        F.lit("cf").alias("cf"), F.lit("cq").alias("cq"), F.lit("1").alias("value"))
    store.add(rows, "r")
    assert store.counts().where("row = 'hot'").first()["n"] == 30_000 and store.counts().count() == 60_001


def test_a_large_store_shuffles_nothing_and_holds_the_same(spark):
    def shuffles():
        return spark.sparkContext._jsc.sc().newShuffleId()  # the next one's number

    first = spark.range(3000, numPartitions=6).select(
        F.lit("t.x/y").alias("table_name"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row"),
        F.lit("cf").alias("cf"), F.when(F.col("id") % 7 == 0, None).otherwise("cq").alias("cq"), (F.col("id") % 2).cast("string").alias("value"))
    second = cells_of(spark, [("hot", "z"), ("new", None)]).unionByName(cells_of(spark, [("5", "x")], "other"))
    stores = [CellStore(spark, scratch_path(spark, "store"), buckets=4, large=large) for large in (False, True)]

    def rows(df):
        return Counter(map(tuple, df.collect()))

    for store in stores:
        store.add(first, "a")
    assert len(stores[1]._state()[1][0]["parts"]) == 4 and rows(stores[0].cells()) == rows(stores[1].cells())
    for data, run in ((second, "b"), (first.limit(0), "none"), (second, "c"), (first, "a")):
        before = shuffles()
        changed = stores[1].compact(), stores[1].add(data, run)
        assert run == "none" or shuffles() == before + 1  # but for limit's own
        assert changed == (stores[0].compact(), stores[0].add(data, run)) and stores[1].clean(0) == stores[0].clean(0)
        before = shuffles()
        found = [(rows(stores[1].cells(t)), rows(stores[1].counts(t))) for t in (None, "other", "none")]
        assert shuffles() == before + 1
        assert found == [(rows(stores[0].cells(t)), rows(stores[0].counts(t))) for t in (None, "other", "none")]
    assert held(stores[1])["t.x/y", "hot"] in ("1", "z") and stores[1].counts().where("row = 'hot'").count() == 2
    files = stores[1].spark.read.parquet(f"{stores[1].path}/{next(iter(stores[1]._base()[1]['parts'].values()))}").collect()
    assert [r["row"] for r in files] == sorted(r["row"] for r in files)


def test_json_runs_commit_their_counters(spark):
    lines = spark.createDataFrame([(x,) for x in ['{"a":"1","a":"2"}', '{"c":null}', "junk", '{"d":"2"}']], "json string")
    store = CellStore(spark, scratch_path(spark, "store"))
    for _ in range(2):
        got = store_json_run(lines, [map_event_generator("ev", "x")], store, "lines")
        assert got == {"bad_records": 1, "failed_store": 1, "records_stored": 2, "total": 3}
    assert sorted((r["cq"], r["value"]) for r in store.cells().collect()) == [("A", "2"), ("D", "2")]  # of a repeated key the last
    assert json.loads(store.folder.read("pending/lines.json"))["counters"] == got


def test_the_store_command_adds_each_input_once(spark, capsys):
    base = scratch_path(spark, "cli-store")
    for name, records in (("a", [("a.", "A")]), ("b", [("b.", "A"), ("c.", "A")])):
        spark.createDataFrame(records, "name string, type string").write.parquet(f"{base}/{name}")
        spark.createDataFrame([(f'{{"name":"{n}"}}',) for n, _ in records], "value string").write.text(f"{base}/{name}-json")
    for keyed in ([], ["--keyed", "--compact"]):
        out = f"{base}/cells{len(keyed)}"
        for name in ("a", "b", "a", "a-json", "b-json", "a-json"):
            form = ["--in-format", "json"] if "json" in name else []
            main(["store", f"{base}/{name}", out, "--events", "ev:dns", *form, *keyed], spark)
            counted = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
            assert counted["records_stored"] == counted["total"] == (1 if name.startswith("a") else 2)
        cells = CellStore(spark, out).cells() if keyed else spark.read.parquet(out)
        assert sorted((r["cq"], r["value"]) for r in cells.collect()) == [("NAME", n) for n in ("a.", "a.", "b.", "b.", "c.", "c.")] + [("TYPE", "A")] * 3


def test_raw_cells_of_two_sets(spark):
    path = scratch_path(spark, "raw-cells")
    a, b = cells_of(spark, [("r1", "1")]), cells_of(spark, [("r2", "1")])
    for cells, run in ((a, "a"), (b, "b"), (a, "a")):
        write_cells(cells, path, run)
    assert sorted(r["row"] for r in spark.read.parquet(path).collect()) == ["r1", "r2"]


def test_a_stream_into_the_store(spark):
    src = scratch_path(spark, "records")
    df = spark.createDataFrame([("a.", "A"), ("b.", "A")], "name string, type string")
    store = CellStore(spark, scratch_path(spark, "store"), buckets=2)
    for part in (1, 2, 3):
        df.coalesce(1).write.mode("append").parquet(src)
        q = start_cell_store(spark.readStream.schema(df.schema).parquet(src), [event_generator("ev", "dns")],
                             run_sink(store, "s", compact_every=2), checkpoint=f"{store.path}-progress")
        q.awaitTermination(120)
        # two records of two fields each; seen once more in every batch
        assert store.cells().count() == 4 and {r["n"] for r in store.counts().collect()} == {part}
    run_sink(store, "s")(store.cells(), 1)  # a batch repeated after a restart
    assert {r["n"] for r in store.counts().collect()} == {3}


# --- storage modules ---


def read_back(spark, path):
    names = [n for n in os.listdir(path.replace("file:", "")) if n.startswith("job=")] if os.path.isdir(path.replace("file:", "")) else []
    return Counter(r["row"] for r in spark.read.parquet(path).collect()) if names else Counter()


def test_modules_store_refuse_and_count(spark):
    path = scratch_path(spark, "module")
    rows = cells_of(spark, [(str(i), "v" if i % 10 else None) for i in range(100)]).repartition(3)
    assert store_records(rows, ParquetFactory(CELLS, rows=7), {"path": path}) == {"records_stored": 90, "failed_store": 10}
    assert store_records(rows, ParquetFactory(CELLS), {"path": path})["records_stored"] == 90
    assert set(read_back(spark, path).values()) == {2} and len(read_back(spark, path)) == 90
    none = store_records(rows.where("false"), ParquetFactory(CELLS), {"path": path})
    assert none == {"records_stored": 0, "failed_store": 0}


def test_modules_take_records_with_any_keys(spark):
    schema = pa.schema([pa.field("shop", pa.string(), nullable=False), pa.field("x", pa.string())])
    path = scratch_path(spark, "module")
    rows = spark.createDataFrame([({"shop": "a", "z": "1"},), ({"x": "b"},), (None,)], "fields map<string,string>")
    assert store_records(rows, ParquetFactory(schema), {"path": path}) == {"records_stored": 1, "failed_store": 2}


def test_a_failed_task_stores_nothing(spark):
    class Broken(ParquetFactory):
        def create(self, conf):
            module = super().create(conf)
            flush = module.flush

            def late():
                flush()
                raise OSError("disk gone")

            module.flush = late
            return module

    path = scratch_path(spark, "module")
    with pytest.raises(Exception, match="disk gone"):
        store_records(cells_of(spark, [("1", "v")]), Broken(CELLS), {"path": path})
    assert read_back(spark, path) == Counter()


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from rrspark.sinks.module import CELLS, ParquetFactory, store_records

class Killed(ParquetFactory):
    def create(self, conf):
        module = super().create(conf)
        store = module.store

        def dying(record):
            store(record)
            if record["row"] == "7":
                module.flush()
                try:
                    os.close(os.open({flag!r}, os.O_CREAT | os.O_EXCL))  # only once, unless always
                    os._exit(1)
                except FileExistsError:
                    if {always}:
                        os._exit(1)

        module.store = dying
        return module

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {path!r} + "-ckpt")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(0, 40, 1, 4).select(*[F.lit(c).alias(c) for c in ("table_name", "cf", "cq", "value")], F.col("id").cast("string").alias("row"))
print("COUNTED", store_records(rows, Killed(CELLS), {{"path": {path!r}, "job": "j"}}))
"""


@pytest.mark.parametrize("always", [False, True])
def test_a_killed_task_leaves_no_cell(spark, always):
    path = arrow_filesystem(scratch_path(spark, "module"))[1]
    os.makedirs(path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = KILLED.format(root=root, flag=f"{path}-flag", path=path, always=always)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    if always:
        assert out.returncode != 0 and "COUNTED" not in out.stdout and read_back(spark, path) == Counter()
    else:  # the second attempt's file counts, what the first had written doesn't
        assert "COUNTED {'records_stored': 40, 'failed_store': 0}" in out.stdout, out.stderr[-2000:]
        assert read_back(spark, path) == Counter(str(i) for i in range(40))
