"""The store of tables in parts: what a write touches, what a cut-off write leaves, versions and expiry."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from forgerank.operators import upsert as U
from forgerank.sources.store import Store, day_part, hash_part


def files(store):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{store.path}/data/*/*/*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def scores(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("username"), F.col("id").cast("double").alias("total_score"))
    return Store.of(df, str(tmp_path / "scores"), hash_part(["username"], 16))


def one(spark, name, score):
    return spark.createDataFrame([(name, score)], "username string, total_score double")


def change(old, new):
    return U.upsert(old, new, ["username"], ["total_score"])


def test_a_write_leaves_the_files_of_other_parts(spark, scores):
    before, parts = files(scores), scores.parts()
    assert scores.merge(one(spark, "u7", -1.0), change)
    after, now = files(scores), scores.parts()
    assert before.items() <= after.items()
    touched = [p for p in now if now[p]["write"] != parts[p]["write"]]
    assert len(touched) == 1 and len(now) == 16
    assert all(f"__part={touched[0]}/" in f for f in after.keys() - before.keys())
    got = dict(rows(scores.read()))
    assert len(got) == 1000 and got["u7"] == -1.0
    assert dict(rows(scores.read(version=1)))["u7"] == 7.0


def test_a_merge_reads_its_own_parts_only(spark, scores):
    seen = []
    scores.merge(one(spark, "u7", 2.0), lambda old, new: seen.extend(old.inputFiles()) or change(old, new))
    part = scores.touched(one(spark, "u7", 0.0))[0]
    assert seen and all(f"__part={part}/" in f for f in seen)


def test_a_run_cut_off_before_the_swap_changes_nothing(spark, scores, monkeypatch):
    want, version = rows(scores.read()), scores.version()
    monkeypatch.setattr(Store, "_publish", lambda self, m: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        scores.merge(one(spark, "u7", -1.0), change)
    monkeypatch.undo()
    assert rows(scores.read()) == want and scores.version() == version
    assert scores.merge(one(spark, "u8", -1.0), change)  # over the remains of the lost run
    assert dict(rows(scores.read()))["u7"] == 7.0 and dict(rows(scores.read()))["u8"] == -1.0


def test_a_tag_is_written_once(spark, scores):
    assert scores.merge(one(spark, "u7", -1.0), change, tag="3")
    assert not scores.merge(one(spark, "u7", -2.0), change, tag="3")
    assert dict(rows(scores.read()))["u7"] == -1.0


def test_two_writers_do_not_both_publish(spark, scores):
    m = scores.manifest()
    scores.merge(one(spark, "u7", -1.0), change)
    with pytest.raises(FileExistsError):
        scores._write(m, one(spark, "u7", -2.0), scores.touched(one(spark, "u7", 0.0)), None)
    assert dict(rows(scores.read()))["u7"] == -1.0


def test_rows_of_untouched_parts_are_refused(spark, scores):
    with pytest.raises(ValueError):
        scores.merge(one(spark, "u7", 0.0), lambda old, new: spark.range(50).select(
            F.concat(F.lit("u"), "id").alias("username"), F.lit(0.0).alias("total_score")))
    assert dict(rows(scores.read()))["u8"] == 8.0


def test_vacuum_keeps_what_is_current(spark, scores):
    for k in range(3):
        scores.merge(one(spark, "u7", float(-k)), change)
    want = rows(scores.read())
    scores.vacuum()
    assert rows(scores.read()) == want and len(scores.files.names(f"{scores.path}/manifests")) == 1
    live = {scores.folder(p, e["write"]) for p, e in scores.parts().items()}
    assert {os.path.dirname(f) for f in files(scores)} == live


def test_null_keys_empty_batches_and_emptied_parts(spark, tmp_path):
    empty = one(spark, "x", 1.0).limit(0)
    store = Store.of(empty, str(tmp_path / "s"), hash_part(["username"], 4))
    assert rows(store.read()) == [] and not store.merge(empty, change)
    store.merge(one(spark, None, 5.0), change)
    store.merge(one(spark, None, 6.0), change)
    assert rows(store.read()) == [(None, 6.0)]
    store.merge(one(spark, None, 6.0), lambda old, new: old.limit(0))
    assert rows(store.read()) == [] and store.parts() == {}


def landed(spark):
    return spark.range(100).select(F.concat(F.lit("k"), "id").alias("cache_key"), F.expr(
        "timestamp_ntz'2024-01-01 12:00:00' + make_interval(0,0,0,cast(id % 10 as int),cast(id % 7 as int))").alias("expires_at"))


def test_purge_drops_days_and_rewrites_the_boundary(spark, tmp_path):
    store = Store.of(landed(spark), str(tmp_path / "landing"), day_part("expires_at"))
    as_of = F.expr("timestamp_ntz'2024-01-05 15:00:00'")
    before, parts = files(store), store.parts()
    U.purge_expired_parts(store, as_of)
    assert rows(store.read()) == rows(U.purge_expired(landed(spark), as_of))
    now = store.parts()
    assert min(now) == "2024-01-05" and [p for p in now if now[p] != parts[p]] == ["2024-01-05"]
    assert before.items() <= files(store).items()
    live = U.live_parts(store, as_of)
    assert rows(live) == rows(U.live_responses(landed(spark), as_of))
    assert all(f.split("__part=")[1][:10] >= "2024-01-05" for f in live.inputFiles())


def test_purge_of_nothing_and_of_rows_without_expiry(spark, tmp_path):
    df = landed(spark).unionByName(spark.createDataFrame([("none", None)], "cache_key string, expires_at timestamp_ntz"))
    store = Store.of(df, str(tmp_path / "landing"), day_part("expires_at"))
    early = F.expr("timestamp_ntz'2023-01-01 00:00:00'")
    U.purge_expired_parts(store, early)
    assert rows(store.read()) == rows(U.purge_expired(df, early))
    late = F.expr("timestamp_ntz'2025-01-01 00:00:00'")
    U.purge_expired_parts(store, late)
    assert rows(store.read()) == [] and rows(U.live_parts(store, late)) == []
