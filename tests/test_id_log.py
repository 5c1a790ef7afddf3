"""The log of seen ids: exact answers, few bytes for new ids, levels, replay."""

import glob
import os

from pyspark.sql import functions as F

from forgerank.sources.id_log import IdLog


def ids(spark, a, b):
    return spark.range(a, b).select(F.concat(F.lit("pr-"), "id").alias("id"))


def size(folders):
    return sum(os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/*.parquet"))


def test_answers_are_exact(spark, tmp_path):
    log = IdLog(spark, str(tmp_path / "log"), 8, fanout=3)
    seen = set()
    for k in range(7):
        batch = ids(spark, 50 * k - 20, 50 * k + 60).union(ids(spark, 0, 5)).union(spark.createDataFrame([(None,)], "id string"))
        want = [r.id for r in batch.collect() if r.id not in seen]
        new = log.unseen(batch)
        assert sorted(map(str, (r.id for r in new.collect()))) == sorted(map(str, want))
        log.add(new, str(k))
        seen |= {x for x in want if x is not None}
        levels = [r["level"] for r in log.manifest()["runs"]]
        assert all(levels.count(x) < 3 for x in levels)
        assert sorted(r.id for r in log._read([f for r in log.manifest()["runs"] for f in log._ids(r)]).collect()) == sorted(seen)


def test_new_ids_do_not_read_the_log(spark, tmp_path):
    """Twenty batches of new ids, each with three old ones: the ids read do not grow with the log."""
    log = IdLog(spark, str(tmp_path / "log"), 64)
    read = []
    for k in range(20):
        batch = ids(spark, 400 * k, 400 * k + 400).union(ids(spark, 0, 3) if k else ids(spark, 0, 0))
        new = log.unseen(batch)
        assert new.count() == 400
        read.append(size(log.last_read))
        log.add(new, str(k))
    whole = size([f for r in log.manifest()["runs"] for f in log._ids(r)])
    assert sum(r["rows"].get(b, 0) for r in log.manifest()["runs"] for b in r["rows"]) == 8000
    assert read[19] < 4 * read[1] + 4096 and read[19] < whole / 5
    assert len(log.manifest()["runs"]) <= 8


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    log = IdLog(spark, str(tmp_path / "log"), 4)
    log.add(ids(spark, 0, 10), "0")
    log.add(ids(spark, 0, 10), "0")
    assert log.has("0") and sum(n for r in log.manifest()["runs"] for n in r["rows"].values()) == 10
    assert IdLog(spark, str(tmp_path / "log"), 99).buckets == 4
    log.add(ids(spark, 0, 0), "1")
    assert log.unseen(ids(spark, 0, 12)).count() == 2


def test_a_run_cut_off_before_the_rename_changes_nothing(spark, tmp_path, monkeypatch):
    log = IdLog(spark, str(tmp_path / "log"), 4)
    log.add(ids(spark, 0, 10), "0")
    monkeypatch.setattr(type(log.files), "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        log.add(ids(spark, 10, 20), "1")
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert not log.has("1") and log.unseen(ids(spark, 0, 20)).count() == 10
    log.add(ids(spark, 10, 20), "1")
    assert log.unseen(ids(spark, 0, 20)).count() == 0
