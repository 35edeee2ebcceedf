"""W1 latest-per-key and K8 upsert semantics."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lucrum.operators.dedup import latest_per_key
from lucrum.operators.upsert import DuplicateKeyError, merge
from lucrum.sinks import tables
from lucrum.sinks.tables import create_table, upsert

D = dt.datetime


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, D(2026, 1, 2), "b"), (1, D(2026, 1, 2), "a"), (1, D(2026, 1, 1), "z"),
         (2, None, "x"), (2, D(2025, 1, 1), "y")],
        "k int, v timestamp, p string")
    out = {r.k: r.p for r in latest_per_key(df, ["k"], "v").collect()}
    assert out == {1: "a", 2: "y"}


def test_latest_per_key_plan_has_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def _tables(spark):
    schema = "k int, v timestamp, val string, part string"
    target = spark.createDataFrame(
        [(1, D(2026, 1, 2), "t1", "a"), (2, D(2026, 1, 2), "t2", "a"), (3, D(2026, 1, 2), "t3", "b"),
         (4, None, "t4", "b"), (None, D(2026, 1, 1), "tn", "b"), (6, D(2026, 1, 2), "t6", "c")],
        schema)
    source = spark.createDataFrame(
        [(1, D(2026, 1, 1), "s1", "a"),          # older  -> keep target
         (2, D(2026, 1, 2), "s2", "a"),          # equal  -> keep target
         (3, D(2026, 1, 3), "s3", "b"),          # newer  -> update
         (4, D(2026, 1, 3), "s4", "b"),          # target version null -> keep
         (5, D(2026, 1, 3), "s5", "e"),          # new    -> insert
         (None, D(2026, 1, 3), "sn", "b"),       # null key never matches -> insert
         (6, D(2026, 1, 3), "s6", "d")],         # newer, moves partition c -> d
        schema)
    return target, source


def test_merge_semantics(spark):
    target, source = _tables(spark)
    out = merge(target, source, ["k"], "v")
    got = sorted((r.k if r.k is not None else -1, r.val) for r in out.collect())
    assert got == [(-1, "sn"), (-1, "tn"), (1, "t1"), (2, "t2"), (3, "s3"), (4, "t4"),
                   (5, "s5"), (6, "s6")]
    always = merge(target, source, ["k"], "v", on_match="always")
    assert {r.val for r in always.collect() if r.k in (1, 2, 4)} == {"s1", "s2", "s4"}


def test_merge_rejects_duplicate_source_keys(spark):
    target, _ = _tables(spark)
    dup = spark.createDataFrame([(1, D(2026, 1, 1), "x", "a"), (1, D(2026, 1, 2), "y", "a")],
                                target.schema)
    with pytest.raises(DuplicateKeyError):
        merge(target, dup, ["k"], "v")


def _new(spark, tmp_path, schema, parts=()):
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_table(spark, name, schema, str(tmp_path / name), parts)
    return name


def _rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_upsert_partitions_and_idempotence(spark, tmp_path):
    target, source = _tables(spark)
    name = _new(spark, tmp_path, target.schema, ["part"])
    assert _rows(spark, name) == []
    assert upsert(spark, name, target, ["k"], "v")["created"]
    untouched = {r.part: r._version for r in tables.current_versions(spark, name).collect()}
    done = upsert(spark, name, source, ["k"], "v", keep_old=["val"])
    first = _rows(spark, name)
    assert ("s6" in {r[2] for r in first}) and ("t6" not in {r[2] for r in first})
    # partition c held only the moved row: it is gone; a has no change and keeps its version
    now = {r.part: r._version for r in tables.current_versions(spark, name).collect()}
    assert set(now) == {"a", "b", "d", "e"} and now["a"] == untouched["a"] and now["b"] != untouched["b"]
    assert done["partitions_emptied"] == 1 and done["partitions_rewritten"] == 3
    assert {(r.val, r._old.val if r._old else None) for r in done["changes"].collect()} == {
        ("s3", "t3"), ("s5", None), ("sn", None), ("s6", "t6")}
    # same batch again: nothing changes except the null-key insert repeats (MERGE semantics)
    again = upsert(spark, name, source.filter(F.col("k").isNotNull()), ["k"], "v")
    assert again["partitions_rewritten"] == 0 and _rows(spark, name) == first
    always = upsert(spark, name, source.filter("k = 1"), ["k"], "v", on_match="always")
    assert always["partitions_rewritten"] == 1 and (1, D(2026, 1, 1), "s1", "a") in _rows(spark, name)


def test_upsert_keeps_rows_of_null_boolean_and_escaped_partitions(spark, tmp_path):
    schema = "k int, v int, flag boolean, route string"
    target = spark.createDataFrame([(1, 1, True, None), (2, 1, None, "a:b"), (3, 1, False, "c d/e"), (4, 1, True, "a:b"), (7, 1, True, "")], schema)
    source = spark.createDataFrame([(5, 1, True, None), (4, 2, True, "z"), (3, 2, False, "c d/e"), (6, 1, None, None)], schema)
    name = _new(spark, tmp_path, target.schema, ["flag", "route"])
    upsert(spark, name, target, ["k"], "v")
    done = upsert(spark, name, source, ["k"], "v")
    want = [(1, 1, True, None), (2, 1, None, "a:b"), (3, 2, False, "c d/e"), (4, 2, True, "z"), (5, 1, True, None), (6, 1, None, None),
            (7, 1, True, None)]      # a folder name can't tell an empty text from null
    assert _rows(spark, name) == sorted(want, key=str)
    assert done["partitions_emptied"] == 1      # (true, a:b) held only the moved row
    assert upsert(spark, name, source, ["k"], "v")["partitions_rewritten"] == 0
    assert _rows(spark, name) == sorted(want, key=str)


def test_upsert_holds_a_batch_against_the_declared_columns_and_types(spark, tmp_path):
    target = spark.createDataFrame([(1, 1, "x")], "k int, v int, extra string")
    name = _new(spark, tmp_path, target.schema)
    upsert(spark, name, target.select("extra", "v", "k"), ["k"], "v")
    with pytest.raises(ValueError, match="extra"):
        upsert(spark, name, target.drop("extra").withColumn("v", F.lit(2)), ["k"], "v")
    with pytest.raises(ValueError, match="types"):
        upsert(spark, name, target.withColumn("extra", F.lit(2)), ["k"], "v")
    assert _rows(spark, name) == [(1, 1, "x")]
    # the first batch too, and a narrower decimal fits
    other = _new(spark, tmp_path, spark.createDataFrame([], "k int, v int, m decimal(18,2)").schema)
    with pytest.raises(ValueError, match="types"):
        upsert(spark, other, target.select("k", "v", F.lit(1.5).alias("m")), ["k"], "v")
    upsert(spark, other, target.select("k", "v", F.lit("1.5").cast("decimal(3,1)").alias("m")), ["k"], "v")
    assert spark.table(other).schema["m"].dataType.simpleString() == "decimal(18,2)"


@pytest.mark.parametrize("parts", [[], ["part"]])
@pytest.mark.parametrize("stop", ["merge", "in_partitions", "_point"])
def test_upsert_that_fails_midway_leaves_the_old_version_readable(spark, tmp_path, monkeypatch, parts, stop):
    """Before any write, between data and list, and just before the view is replaced."""
    target, source = _tables(spark)
    target, source = target.where("k is not null"), source.where("k is not null")
    name = _new(spark, tmp_path, target.schema, parts)
    upsert(spark, name, target, ["k"], "v")
    before, calls, real = _rows(spark, name), [], getattr(tables, stop)

    def fail(*a, **k):
        calls.append(1)
        if stop != "in_partitions" or len(calls) > 1:      # its second call comes after the data are written
            raise OSError("lost")
        return real(*a, **k)

    monkeypatch.setattr(tables, stop, fail)
    with pytest.raises(OSError):
        upsert(spark, name, source, ["k"], "v")
    monkeypatch.undo()
    assert _rows(spark, name) == before
    upsert(spark, name, source, ["k"], "v")
    assert {r[0]: r[2] for r in _rows(spark, name)} == {1: "t1", 2: "t2", 3: "s3", 4: "t4", 5: "s5", 6: "s6"}


def test_a_reader_that_began_before_keeps_its_version(spark, tmp_path):
    target, source = _tables(spark)
    name = _new(spark, tmp_path, target.schema, ["part"])
    upsert(spark, name, target, ["k"], "v")
    before, reader = _rows(spark, name), spark.table(name)
    upsert(spark, name, source, ["k"], "v")
    assert sorted(map(tuple, reader.collect()), key=str) == before != _rows(spark, name)


def test_a_catalog_without_the_table_takes_up_what_was_published(spark, tmp_path):
    target, source = _tables(spark)
    name = _new(spark, tmp_path, target.schema, ["part"])
    upsert(spark, name, target, ["k"], "v")
    upsert(spark, name, source, ["k"], "v")
    other = f"{name}_again"
    create_table(spark, other, target.schema, str(tmp_path / name), ["part"])
    assert _rows(spark, other) == _rows(spark, name)


def test_upsert_reads_only_affected_partitions_and_dead_versions_are_pruned(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"), (F.col("id") % 10).cast("string").alias("part"))
    name = _new(spark, tmp_path, rows.schema, ["part"])
    upsert(spark, name, rows, ["k"], "v")
    there = tables.in_partitions(["part"], rows.schema, [("3",), ("7",)])
    plan = spark.table(name).where(there)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "part" in filters and "dynamicpruning" in filters
    for _ in range(2):
        upsert(spark, name, rows.where("part = '3'").withColumn("v", F.lit(2)), ["k"], "v", on_match="always")
    live = tables.current_versions(spark, name)
    assert live.select("_version").distinct().count() == 2 and live.count() == 10       # the one between is dead
    assert spark.table(f"{name}_data").select("_version").distinct().count() == 3
    assert spark.table(name).count() == 100 and spark.table(name).where("v = 2").count() == 10


def _stored_side_exchanges(df, name):
    """Exchanges between a scan of the table's data and the top of the plan, below the first join."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(plan) if f"{name}_data[" in x and "Scan" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    found, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            level = depth(line)
            found.append(line.strip(" :+-"))
    return [x for x in found if x.split("(")[0].strip(" *0123456789)").startswith("Exchange hashpartitioning") or "Exchange hashpartitioning" in x]


def test_a_bucketed_table_is_not_shuffled_by_upsert_and_allocation(spark, tmp_path):
    from lucrum.operators.allocate import allocate
    rows = spark.range(400).select(F.col("id").alias("k"), F.lit(1).alias("v"), (F.col("id") % 20).alias("g"), (F.col("id") % 7 + 1.0).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name, by_group = f"t_{uuid.uuid4().hex[:8]}", f"t_{uuid.uuid4().hex[:8]}"
        create_table(spark, name, rows.schema, str(tmp_path / name), bucket_by=["k"], buckets=8)
        upsert(spark, name, rows, ["k"], "v")
        joined = merge(spark.table(name), rows.withColumn("v", F.lit(2)), ["k"], "v", check_unique=False)
        assert _stored_side_exchanges(joined, name) == []
        done = upsert(spark, name, rows.where("k < 50").withColumn("v", F.lit(2)), ["k"], "v")
        assert done["partitions_rewritten"] == 1 and spark.table(name).where("v = 2").count() == 50 and spark.table(name).count() == 400
        create_table(spark, by_group, rows.schema, str(tmp_path / by_group), bucket_by=["g"], buckets=8)
        upsert(spark, by_group, rows.withColumn("g", F.when(F.col("g") > 0, F.col("g"))), ["k"], "v")
        costs = spark.range(15).select("id", (F.col("id") + 0.5).alias("c"))
        bucketed = allocate(spark.table(by_group), "g", "w", costs, "id", "c", method="bucketed")
        assert _stored_side_exchanges(bucketed, by_group) == []
        plain = allocate(spark.table(by_group), "g", "w", costs, "id", "c")
        assert sorted(map(tuple, bucketed.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
