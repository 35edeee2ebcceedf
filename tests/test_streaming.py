"""Streaming forms equal their batch forms; replays change nothing."""

import uuid

from pyspark.sql import functions as F

from lucrum.operators import windows as W
from lucrum.operators.dedup import latest_per_key
from lucrum.plans import standins as S
from lucrum.sinks.tables import create_table
from lucrum.streaming import pending, stream_upsert, stream_window_counts, stream_work_list
from lucrum.streaming.work_list import INPUT


def _land_batches(spark, sf, root, n=4):
    e = S.events(spark, sf)
    for i in range(n):
        e.filter(F.col("event_id") % n == i).write.mode("append").parquet(root)
    return e


def test_stream_upsert_equals_batch_and_replay_is_noop(spark, sf_small, tmp_path):
    src, target = str(tmp_path / "src"), f"t_{uuid.uuid4().hex[:8]}"
    e = _land_batches(spark, sf_small, src)
    create_table(spark, target, e.schema, str(tmp_path / "target"), ["event_type"])
    keys = ["user_id", "event_type"]
    stream_upsert(spark, src, e.schema, target, str(tmp_path / "ckpt"), keys, "ts",
                  tiebreak=["event_id"], max_files_per_trigger=2)
    got = sorted(map(tuple, spark.table(target).collect()))
    want = sorted(map(tuple, latest_per_key(e, keys, "ts", ["event_id"]).collect()))
    assert got == want
    # same files through a new checkpoint: every version is equal -> unchanged
    stream_upsert(spark, src, e.schema, target, str(tmp_path / "ckpt2"), keys, "ts",
                  tiebreak=["event_id"])
    assert sorted(map(tuple, spark.table(target).collect())) == want


def test_stream_window_counts_equal_batch(spark, sf_small, tmp_path):
    src, target = str(tmp_path / "src"), f"t_{uuid.uuid4().hex[:8]}"
    e = _land_batches(spark, sf_small, src)
    windows = W.tile(spark, S.events_now(spark, sf_small))
    start = windows.agg(F.min("date_from")).first()[0]
    stream_window_counts(spark, src, e.schema, "ts", start, target, str(tmp_path / "counts"), str(tmp_path / "ckpt"),
                         max_files_per_trigger=2)
    got = {r.window_start: r.n_rows for r in spark.table(target).collect()}
    want = {r.date_from: r.n_rows for r in W.counts(e, "ts", windows).collect() if r.n_rows}
    assert got == want


def test_window_counts_do_not_depend_on_files_per_trigger_or_checkpoint(spark, sf_small, tmp_path):
    src = str(tmp_path / "src")
    e = _land_batches(spark, sf_small, src, n=5)
    windows = W.tile(spark, S.events_now(spark, sf_small))
    start = windows.agg(F.min("date_from")).first()[0]
    want = {r.date_from: r.n_rows for r in W.counts(e, "ts", windows).collect() if r.n_rows}
    for files in (1, 2, 8):
        target = f"t_{uuid.uuid4().hex[:8]}"
        for run in range(2 if files == 2 else 1):       # the second with a new checkpoint
            stream_window_counts(spark, src, e.schema, "ts", start, target, str(tmp_path / f"counts{files}"), str(tmp_path / f"c{files}-{run}"),
                                 max_files_per_trigger=files)
            assert {r.window_start: r.n_rows for r in spark.table(target).collect()} == want


def _news(spark, root, batches):
    for batch in batches:
        spark.createDataFrame(batch, INPUT).coalesce(1).write.mode("append").parquet(root)


def test_work_list_equals_the_anti_join_for_any_batches_and_after_a_restart(spark, tmp_path):
    batches = [[(i, False) for i in range(1, 20)] + [(0, False), (None, False)], [(i, True) for i in range(1, 20, 3)],
               [(i, False) for i in range(10, 30)], [(25, True), (40, True), (2, True)], [(40, False), (5, False), (41, False), (41, True)]]
    want = {i for b in batches for i, f in b if i and not f} - {i for b in batches for i, f in b if f}
    for files in (1, 3):
        src, name = str(tmp_path / f"src{files}"), f"t_{uuid.uuid4().hex[:8]}"
        for part in (batches[:3], batches[3:]):          # the second run goes on from the checkpoint
            _news(spark, src, part)
            stream_work_list(spark, src, name, str(tmp_path / name), str(tmp_path / f"ckpt{files}"), max_files_per_trigger=files)
        assert {r.shipping_id for r in pending(spark, name).collect()} == want
        assert spark.table(name).where("not done and offers <> 1").count() == 0      # offered once, no retry is due yet


def test_work_list_offers_again_after_the_retry_time(spark, tmp_path):
    src, name = str(tmp_path / "src"), f"t_{uuid.uuid4().hex[:8]}"
    for batch in ([(1, False), (2, False)], [(2, True), (3, False)], [(4, False)]):
        _news(spark, src, [batch])
        stream_work_list(spark, src, name, str(tmp_path / name), str(tmp_path / "ckpt"), retry_ms=1)
    rows = {r.shipping_id: r for r in spark.table(name).collect()}
    assert rows[1].offers >= 2 and not rows[1].done and rows[2].done and rows[4].offers == 1


def test_events_land_in_files_by_their_rows_not_by_the_scans_tasks(spark, tmp_path):
    ids = [*range(40), 3, None, -4, -5]
    e = spark.createDataFrame([(i,) for i in ids], "event_id long").repartition(6)
    for rows, least, most in ((1_000, 5, 5), (4, 6, 12)):      # batches of 9 (-5 too), 8, 8, 9 (3 twice) and 8 rows
        src = str(tmp_path / f"src{rows}")
        S.land_events(e, src, rows_a_file=rows)
        got = spark.read.parquet(src)
        assert least <= len(got.inputFiles()) <= most
        assert sorted(r[0] for r in got.collect()) == sorted([*range(40), 3, -5])
