"""The keyed upsert commits: what dies before leaves the table, what dies after is finished, nobody's rows are lost."""

import datetime as dt
import pathlib

import pytest

from airspark.sources import store as ST

T0 = dt.datetime(2024, 1, 1)


def rows(spark, city, hours, value, run):
    return spark.createDataFrame([(city, T0 + dt.timedelta(hours=h), T0 + dt.timedelta(days=run), float(value)) for h in hours],
                                 "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, v double")


def content(spark, path):
    schema = rows(spark, "a", [0], 1, 1).schema
    return sorted((r.city, (r.timestamp - T0).total_seconds() / 3600, r.v) for r in ST.read_keyed(spark, path, schema).collect())


@pytest.mark.parametrize("first", [True, False])
def test_a_write_that_dies_before_its_commit_leaves_the_table(spark, tmp_path, monkeypatch, first):
    path = f"{tmp_path}/t"
    if not first:
        ST.keyed_upsert(rows(spark, "a", range(3), 1, 1), path)
    with monkeypatch.context() as m:
        m.setattr(ST._Commits, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ST.keyed_upsert(rows(spark, "a", range(5), 9, 2), path)
    assert ST.table_exists(spark, path) is not first
    if not first:
        assert content(spark, path) == [("a", h, 1.0) for h in range(3)]
    ST.keyed_upsert(rows(spark, "a", [2], 2, 2), path)
    assert content(spark, path) == ([] if first else [("a", 0, 1.0), ("a", 1, 1.0)]) + [("a", 2, 2.0)]


def test_a_write_that_dies_while_it_is_put_in_place_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    ST.keyed_upsert(rows(spark, "a", range(3), 1, 1).union(rows(spark, "b", range(2), 1, 1)), path)
    with monkeypatch.context() as m:
        def dies(self, name, partition_by):
            for f in pathlib.Path(path).glob("city=a/*.parquet"):  # the old files are gone, the new ones not yet there
                f.unlink()
            raise RuntimeError("lost")
        m.setattr(ST._Commits, "apply", dies)
        with pytest.raises(RuntimeError):
            ST.keyed_upsert(rows(spark, "a", [1, 7], 2, 2), path)
    ST.keyed_upsert(rows(spark, "b", [5], 3, 3), path, patience=0)
    assert content(spark, path) == [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 1.0), ("a", 7, 2.0), ("b", 0, 1.0), ("b", 1, 1.0), ("b", 5, 3.0)]
    assert not list(pathlib.Path(path).glob("_staged/*")) and [p.name for p in pathlib.Path(path).glob("_commits/[0-9]*")] == ["3"]


def test_a_marker_without_content_commits_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    ST.keyed_upsert(rows(spark, "a", range(2), 1, 1), path)
    (pathlib.Path(path) / "_commits" / "2").touch()
    ST.keyed_upsert(rows(spark, "a", [1], 2, 2), path, patience=0)
    assert content(spark, path) == [("a", 0, 1.0), ("a", 1, 2.0)]


def test_a_slower_writer_merges_anew(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    ST.keyed_upsert(rows(spark, "a", range(2), 1, 1), path)
    commit, turns = ST._Commits.commit, []

    def other_first(self, *args):
        turns.append(args[0])
        if len(turns) == 1:  # between our merge and our commit another writer gets through
            ST.keyed_upsert(rows(spark, "a", [8], 5, 2), path)
        return commit(self, *args)

    monkeypatch.setattr(ST._Commits, "commit", other_first)
    ST.keyed_upsert(rows(spark, "a", [9], 6, 2), path)
    assert content(spark, path) == [("a", 0, 1.0), ("a", 1, 1.0), ("a", 8, 5.0), ("a", 9, 6.0)]
    assert turns == [2, 2, 3]
    monkeypatch.setattr(ST._Commits, "commit", lambda *a: False)
    with pytest.raises(RuntimeError, match="faster"):
        ST.keyed_upsert(rows(spark, "a", [9], 7, 3), path, attempts=2)


def test_scratch_is_released(spark, tmp_path, monkeypatch):
    from airspark import session
    monkeypatch.setattr(session, "_SCRATCH", {})
    kept = session.scratch_path(spark, "never-written")
    done = session.checkpoint(spark.range(3), "released")
    assert done.count() == 3 and not session.path_exists(spark, kept)
    (path,) = [p for p in session._SCRATCH[spark.sparkContext.applicationId] if p != kept]
    assert session.release_scratch(spark) == 1 and not session.path_exists(spark, path)
    assert session.release_scratch(spark) == 0
