"""Numbered log entries, folds and published snapshots."""

import builtins
import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sampling import split
from tidemark.sources import snapshots, store
from tidemark.sources.ledgers import Ledger, Registry
from tidemark.sources.store import HadoopStore, MountedStore, open_store

SCHEMA = "seq bigint, name string"


@pytest.fixture(params=["mounted", "hadoop"])
def folder(request, spark, tmp_path):
    path = f"{tmp_path}/store"
    return MountedStore(path) if request.param == "mounted" else HadoopStore(spark, f"file:{path}")


def test_a_file_is_created_once(folder):
    assert folder.names() == [] and folder.read("a") is None
    assert folder.put_if_absent("b", b"one") and folder.put_if_absent("a", b"\x00\xff")
    assert not folder.put_if_absent("b", b"two")
    assert folder.read("b") == b"one" and folder.read("a") == b"\x00\xff"
    assert folder.names() == ["a", "b"]
    folder.delete("b")
    folder.delete("b")
    assert folder.names() == ["a"]


def test_store_follows_the_path(spark, tmp_path):
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        found = open_store(spark, path)
        assert isinstance(found, MountedStore) and found.folder.rstrip("/") == str(tmp_path)


def test_one_of_many_writers_gets_a_name(tmp_path):
    folder = MountedStore(str(tmp_path))
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda k: folder.put_if_absent("x", str(k).encode()), range(64)))
    assert sum(won) == 1 and folder.read("x") == str(won.index(True)).encode()
    assert os.listdir(tmp_path) == ["x"]


def test_eight_writers_get_all_numbers(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=7)
    with ThreadPoolExecutor(8) as pool:
        seqs = list(pool.map(lambda k: ledger.append(name=f"n{k}"), range(400)))
    assert sorted(seqs) == list(range(1, 401))
    rows = ledger.read().collect()
    assert sorted(r["seq"] for r in rows) == list(range(1, 401))
    assert {r["name"]: r["seq"] for r in rows} == {f"n{k}": s for k, s in enumerate(seqs)}
    assert ledger.last("seq", "name") == (400, f"n{seqs.index(400)}")


def test_a_long_ledger_is_read_from_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(os, "fsync", lambda fd: None)
    ledger = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=40)
    for k in range(2000):
        ledger.append(name=f"n{k}")
    opened = []
    plain = builtins.open
    monkeypatch.setattr(store, "open", lambda *a: (opened.append(a[0]), plain(*a))[1], raising=False)
    assert ledger.last("name") == "n1999"
    assert len(opened) <= 2
    opened.clear()
    rows = ledger.read()
    assert len(opened) <= 1 + ledger.fold_every
    assert len(rows.inputFiles()) <= 17
    assert rows.agg(F.count("seq"), F.min("seq"), F.max("seq"), F.count_distinct("name")).first() == (
        2000, 1, 2000, 2000,
    )
    assert len(os.listdir(f"{tmp_path}/l/log")) <= 2 * ledger.fold_every
    assert len(os.listdir(f"{tmp_path}/l/folds")) == 2


def test_a_late_writer_does_not_take_an_old_number(spark, tmp_path):
    """It saw the ledger long ago; meanwhile its number was used, folded and deleted."""
    ledger = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=3)
    ledger.append(name="first")
    slow = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=3)
    seen = slow._high()
    views = iter([seen])
    now = Ledger._high

    class Slow(Ledger):
        def _high(self):
            return next(views, None) or now(self)

    for k in range(12):
        ledger.append(name=f"n{k}")
    assert f"{2:020d}.json" not in os.listdir(f"{tmp_path}/l/log")
    assert Slow(spark, f"{tmp_path}/l", SCHEMA, fold_every=3).append(name="late") == 14
    rows = {r["seq"]: r["name"] for r in ledger.read().collect()}
    assert len(rows) == 14 and rows[2] == "n0" and rows[14] == "late"


def test_an_own_entry_that_was_folded_at_once_is_kept(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=100)

    class Interrupted(Ledger):
        def _was_folded(self, view, number, token):
            asked.append(number)
            return super()._was_folded(view, number, token)

        def _view(self):
            view = super()._view()
            if len(view.tail) == 4 and not asked:
                asked.append(0)
                self._fold(view)
                return super()._view()
            return view

    asked = []
    for k in range(3):
        ledger.append(name=f"n{k}")
    assert Interrupted(spark, f"{tmp_path}/l", SCHEMA, fold_every=100).append(name="mine") == 4
    assert asked == [0, 4]
    assert sorted(r["seq"] for r in ledger.read().collect()) == [1, 2, 3, 4]


def test_values_come_back(spark, tmp_path):
    schema = "seq bigint, at timestamp, m map<string,double>, s string, x double, n bigint"
    ledger = Ledger(spark, f"{tmp_path}/l", schema, fold_every=2)
    at = datetime(2024, 2, 3, 4, 5, 6, 789_012, tzinfo=timezone.utc)
    odd = {"at": at, "m": {"a": 0.1, "b": float("nan")}, "s": 'é "\n', "x": 1e-300, "n": 2**53 + 1}
    empty = {"at": None, "m": None, "s": None, "x": None, "n": None}
    for _ in range(3):
        ledger.append(**odd)
        ledger.append(**empty)
    rows = ledger.read().orderBy("seq").select(*odd).collect()
    for row in rows[::2]:
        assert repr(row["m"]) == repr(odd["m"]) and row["at"] == at.astimezone().replace(tzinfo=None)
        assert [row[c] for c in ("s", "x", "n")] == [odd[c] for c in ("s", "x", "n")]
    assert all(set(row) == {None} for row in rows[1::2])
    with pytest.raises(ValueError, match="has the fields"):
        ledger.append(s="only")


def test_whole_tables_and_records_mix(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/l", SCHEMA, fold_every=2)
    rows = spark.range(10, 20).select(F.col("id").alias("seq"), F.lit("bulk").alias("name"))
    ledger.append_table(rows.where("seq <> 12"))
    assert ledger.append(name="next") == 20
    ledger.append_table(rows.where("seq = 12"))
    assert ledger.last("seq", "name") == (20, "next")
    assert [ledger.append(name=n) for n in "abc"] == [21, 22, 23]
    ledger.append_table(rows.where("false"))
    found = sorted((r["seq"], r["name"]) for r in ledger.read().collect())
    assert found == [(k, "bulk") for k in range(10, 20)] + [(20, "next"), (21, "a"), (22, "b"), (23, "c")]
    assert ledger.read().select("record").distinct().count() == 6


def table(spark, n=100):
    return split(spark.range(n).withColumn("x", F.col("id") * 2), ["id"])


def test_jobs_of_one_second_get_two_ids(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: registry.reserve(), range(8)))
    assert len(set(ids)) == 8 and all(len(i) == 14 for i in ids)
    with pytest.raises(ValueError, match="taken"):
        registry.reserve(ids[0])


def test_a_killed_job_leaves_nothing_a_reader_sees(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    done, killed, slow = (registry.reserve() for _ in range(3))
    for snapshot_id in (done, killed, slow):
        snapshots.write_snapshot(table(spark), registry.snapshot_root, snapshot_id)
    registry.publish(done, 100, table_path="t")
    assert registry.last_snapshot() == done
    assert registry.snapshot(done)["table_path"] == "t"
    with pytest.raises(ValueError, match="published"):
        registry.snapshot(killed)
    assert registry.sweep(older_than=3600) == []
    assert registry.sweep(older_than=0) == sorted([killed, slow])
    left = os.listdir(registry.snapshot_root)
    assert left == [f"snapshot_id={done}"]
    with pytest.raises(ValueError, match="swept"):
        registry.publish(slow, 100)
    assert registry.sweep(older_than=0) == []
    assert registry.snapshots.read().count() == 1 and not registry.abandon(done)


def test_a_decided_snapshot_gets_its_record(spark, tmp_path, monkeypatch):
    """The job dies after the decision, before the ledger has the manifest."""
    registry = Registry(spark, str(tmp_path))
    snapshot_id = registry.reserve()
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "append", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            registry.publish(snapshot_id, 7, table_path="t")
    assert registry.last_snapshot() is None
    assert registry.sweep(older_than=0) == []
    assert registry.last_snapshot() == snapshot_id and registry.snapshot(snapshot_id)["n_rows"] == 7


def test_failed_preparation_is_withdrawn(spark, tmp_path, monkeypatch):
    from test_registry import SPEC, customers

    from tidemark.plans import prepare

    registry = Registry(spark, str(tmp_path))

    def fail(*args):
        raise OSError("disk lost")

    with monkeypatch.context() as patch:
        patch.setattr(prepare.FeatureState, "save", fail)
        with pytest.raises(OSError, match="disk lost"):
            prepare.prepare_snapshot(registry, customers(spark, 200), SPEC, "m", "20240101000000")
    assert registry.last_snapshot() is None
    assert os.listdir(registry.snapshot_root) == []
    prepare.prepare_snapshot(registry, customers(spark, 200), SPEC, "m", "20240102000000", test_size=0.5)
    row = registry.snapshot("20240102000000")
    assert spark.read.parquet(row["profile_path"]).count() > 0
    assert spark.read.parquet(row["table_path"]).count() == row["n_rows"]
    tested = spark.read.parquet(row["table_path"]).where("copy_no = 1").groupBy("split").count().collect()
    sides = {r["split"]: r["count"] for r in tested}
    assert 0.3 < sides["test"] / sum(sides.values()) < 0.7
    assert json.loads(open(f"{tmp_path}/reserved/20240101000000").read())["reserved_at"]
