"""WARC archives: exact round trips, partitions, pushed predicates, skipped payloads."""

import base64
import gzip
import hashlib
import json
import os
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, StringContains, StringStartsWith

from tidemark.llm import warc

PAGES = "page_id long, url string, html string"
ODD = [
    (3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, "http://a/2", "same"),
    (7, None, None), (8, "http://a/ü x\ny", ""),
    (None, "http://n/", "nulls"), (None, "http://m/", "nulls"),
    (5, "u", "twice"), (5, "u", "twice"), (5, "v", "twice"), (6, "w", "twice"),
    (9, "x", "héé\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n"),
    (10, "big", "0123456789" * 300_000), (11, "big", "0123456789" * 300_000), (-4, "neg", "<html>"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def by_hand(rows, min_bytes=0):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append((page_id is None, page_id or 0))
    seen = set()
    for page_id, _, html in rows:
        body, me = html or "", (page_id is None, page_id or 0)
        first = min(groups[body])
        alone = len(body.encode()) < min_bytes
        response = alone or (me == first and (body, me) not in seen)
        if me == first:
            seen.add((body, me))
        refers = None if response or first[0] else first[1]
        yield page_id, len(body.encode()), digest(html), "response" if response else "revisit", refers


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(str(v) for v in r))


def archived(spark, rows, path, parts=3, extra=lambda df: df, **options):
    warc.archive(extra(spark.createDataFrame(rows, PAGES).repartition(parts)), path, **options)
    return warc.read_pages(spark, path)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"min_bytes": 5}])
def test_round_trip(spark, clashing, tmp_path, options):
    found = archived(spark, ODD, f"{tmp_path}/w", extra=clashing, **options)
    assert order(found.collect()) == order(by_hand(ODD, options.get("min_bytes", 0)))


def test_empty_tables(spark, tmp_path):
    assert archived(spark, [], f"{tmp_path}/w").count() == 0
    assert warc.read(spark, f"{tmp_path}/w").count() == 0


def test_texts_come_back(spark, tmp_path):
    path = f"file:{tmp_path}/w"
    archived(spark, ODD, path).count()
    rows = warc.read(spark, path).where("record_type = 'response'").collect()
    payloads = {r["payload"].decode() for r in rows}
    assert payloads == {html or "" for _, _, html in ODD}
    names = {r["record_id"]: r for r in rows}
    for r in warc.read(spark, path, ["refers_to", "payload", "payload_digest"]).where("refers_to is not null").collect():
        assert r["payload"] is None
        assert names[r["refers_to"]]["payload_digest"] == r["payload_digest"]


def test_hot_and_many_groups(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(600)]
    want = order(by_hand(rows))
    assert order(archived(spark, rows, f"{tmp_path}/a").collect()) == want
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 3)
    monkeypatch.setattr(warc, "HEAVY_SHARE", 20)
    assert order(archived(spark, rows, f"{tmp_path}/b").collect()) == want


def test_files_are_plain_warc(spark, tmp_path):
    """Any reader of gzip finds whole records, whose digests and lengths are right."""
    archived(spark, ODD, f"{tmp_path}/w", parts=1).count()
    (file,) = Path(tmp_path, "w").glob("*.warc.gz")
    data, seen = gzip.decompress(file.read_bytes()), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(named["Content-Length"])
        block, end, data = rest[:n], rest[n : n + 4], rest[n + 4 :]
        assert head.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n"
        if "WARC-Block-Digest" in named:
            sha = base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert named["WARC-Block-Digest"] == f"sha1:{sha}"
        seen.append(named["WARC-Record-ID"])
    assert len(seen) == len(ODD) + 1 == len(set(seen))


def reader(path, columns=("row_id",), **options):
    known = {f.name: f for f in T._parse_datatype_string(warc.READ_SCHEMA).fields}
    schema = T.StructType([known[c] for c in columns])
    return warc.WarcReader(schema, {"path": path, **{k: str(v) for k, v in options.items()}})


def rows_of(made):
    return [r for span in made.partitions() for b in made.read(span) for r in b.to_pylist()]


def test_partitions_split_large_files_and_join_small_ones(spark, tmp_path):
    rows = [(i, f"u{i}", os.urandom(2000).hex()) for i in range(300)]
    path = f"{tmp_path}/w"
    archived(spark, rows, path, parts=2, split_bytes=20_000).count()
    few, many = reader(path), reader(path, partition_bytes=100_000)
    assert len(few.partitions()) == 1
    spans = many.partitions()
    assert 8 <= len(spans) <= 14
    assert all(sum(high - low for _, low, high in s.parts) <= 100_000 for s in spans)
    assert order(r.items() for r in rows_of(few)) == order(r.items() for r in rows_of(many))
    assert len(rows_of(many)) == 300 + 2
    assert warc.read(spark, path, ["row_id"], partition_bytes=100_000).rdd.getNumPartitions() == len(spans)


def test_files_are_rotated(spark, tmp_path):
    rows = [(i, f"u{i}", os.urandom(500).hex()) for i in range(100)]
    found = archived(spark, rows, f"{tmp_path}/w", parts=1, file_bytes=20_000)
    assert len(list(Path(tmp_path, "w").glob("*.warc.gz"))) > 3
    assert order(found.collect()) == order(by_hand(rows))


def test_predicates_are_pushed_down(spark, tmp_path):
    path = f"{tmp_path}/w"
    archived(spark, ODD, path).count()
    made = reader(path)
    left = StringContains(("target_uri",), "a")
    kept = list(
        made.pushFilters(
            [EqualTo(("record_type",), "revisit"), GreaterThan(("row_id",), 2), left, IsNull(("payload",))]
        )
    )
    assert kept == [left, IsNull(("payload",))]
    assert sorted(r["row_id"] for r in rows_of(made)) == [3, 5, 5, 6, 8, 11]
    frame = warc.read(spark, path, ["row_id", "record_type", "target_uri"])
    asked = frame.where("record_type = 'response' and target_uri like 'http://a/%' and row_id in (1, 2, 8)")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan, plan
    assert sorted(r["row_id"] for r in asked.collect()) == [1]
    assert frame.where("row_id is null").count() == 2 + len(list(Path(path).glob("*.gz")))


def test_files_without_a_wanted_type_are_left_out(spark, tmp_path):
    path = f"{tmp_path}/w"
    warc.archive(spark.createDataFrame([(1, "u", "a")], PAGES).coalesce(1), path)
    warc.archive(spark.createDataFrame([(2, "u", "b"), (3, "u", "b")], PAGES).coalesce(1), path)
    made = reader(path)
    assert list(made.pushFilters([In(("record_type",), ("revisit", "metadata"))])) == []
    assert sum(len(s.parts) for s in made.partitions()) == 1
    assert [r["row_id"] for r in rows_of(made)] == [3]


def test_unwanted_payloads_are_not_decoded(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h{i % 10}/{i}", os.urandom(40_000).hex()) for i in range(50)]
    path = f"{tmp_path}/w"
    archived(spark, rows, path, parts=1).count()
    inflated = []
    more = warc.Member._more

    def counted(self, wanted):
        before = len(self.data)
        more(self, wanted)
        inflated.append(len(self.data) - before)

    monkeypatch.setattr(warc.Member, "_more", counted)
    assert len(rows_of(reader(path, ["row_id", "payload_bytes"]))) == 51
    headers_only, inflated[:] = sum(inflated), []
    made = reader(path, ["row_id", "payload"])
    assert list(made.pushFilters([StringStartsWith(("target_uri",), "http://h7/")])) == []
    assert len(rows_of(made)) == 5
    some, inflated[:] = sum(inflated), []
    assert len(rows_of(reader(path, ["row_id", "payload"]))) == 51
    whole = sum(inflated)
    assert headers_only < 0.15 * whole and some < 0.3 * whole


def test_archives_of_other_writers(spark, tmp_path):
    """Members without a stated length, plain files, other record types, folded and odd fields."""
    def record(kind, body, *more):
        named = [f"WARC-Type: {kind}", "warc-record-id: <urn:x:1>", *more, f"Content-Length: {len(body)}"]
        return "\r\n".join(["WARC/1.0", *named, "", ""]).encode() + body + b"\r\n\r\n"

    records = [
        record("warcinfo", b"a: b"),
        record("resource", b"plain body", "WARC-Target-URI: dns:x", "X-Long: one\r\n  two"),
        record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + b"x" * 300_000, "Content-Type: application/http; msgtype=response"),
        record("response", b"no http header", "Content-Type: application/http"),
        record("metadata", b""),
    ]
    Path(tmp_path, "a.warc").write_bytes(b"".join(records))
    Path(tmp_path, "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    found = warc.read(spark, str(tmp_path)).collect()
    assert len(found) == 10
    for file in ("a.warc", "b.warc.gz"):
        got = [r for r in found if r["file"] == file]
        assert [r["payload"] for r in got] == [b"a: b", b"plain body", b"x" * 300_000, b"no http header", b""]
        assert [r["payload_bytes"] for r in got] == [4, 10, 300_000, 14, 0]
        assert got[1]["headers"]["X-Long"] == "one two" and got[1]["row_id"] is None
    assert warc.read(spark, f"{tmp_path}/b.warc.gz", ["payload_bytes"]).count() == 5
    types = warc.read(spark, str(tmp_path), ["record_type"]).where("record_type = 'metadata'")
    assert types.count() == 2


def test_damage_is_named(spark, tmp_path):
    path = f"{tmp_path}/w"
    archived(spark, [(1, "u", "some text")], path, parts=1, compression="none").count()
    (file,) = Path(path).glob("*.warc")
    data = file.read_bytes()
    file.write_bytes(data.replace(b"some text", b"some tExt"))
    assert len(rows_of(reader(path))) == 2
    with pytest.raises(ValueError, match=rf"{re.escape(file.name)}, offset \d+: the payload differs"):
        rows_of(reader(path, verify="true"))
    file.write_bytes(data[:-30])
    with pytest.raises(ValueError, match="ends within a record"):
        rows_of(reader(path, ["payload"]))
    with pytest.raises(ValueError, match="no archive"):
        reader(f"{tmp_path}/none").partitions()


def test_leftovers_are_not_read_and_overwriting_replaces(spark, tmp_path):
    path = f"{tmp_path}/w"
    archived(spark, [(1, "u", "a")], path, parts=1).count()
    (file,) = Path(path).glob("*.warc.gz")
    Path(path, "part-lost.warc.gz").write_bytes(file.read_bytes())
    assert warc.read_pages(spark, path).count() == 1
    warc.archive(spark.createDataFrame([(2, "u", "b")], PAGES), path)
    assert warc.read_pages(spark, path).count() == 2
    warc.archive(spark.createDataFrame([(3, "u", "c")], PAGES), path, mode="overwrite")
    assert [r["page_id"] for r in warc.read_pages(spark, path).collect()] == [3]
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 1


def test_failed_jobs_leave_no_archive(spark, tmp_path):
    path = f"{tmp_path}/w"
    warc.register(spark)
    bad = warc.records(spark.createDataFrame([(1, "u", "a"), (2, "v", "b")], PAGES)).withColumn(
        "payload_sha1", F.when(F.col("row_id") == 2, "no digest").otherwise(F.col("payload_sha1"))
    )
    with pytest.raises(Exception, match="hexadecimal"):
        bad.coalesce(1).write.format("warc").mode("append").save(path)
    assert [f for f in os.listdir(path) if f.startswith(("part-", "_manifest"))] == []
    assert json.dumps(rows_of(reader(path))) == "[]"


def test_cursor_reads_far_and_near(tmp_path):
    data = os.urandom(1_000_000)
    Path(tmp_path, "f").write_bytes(data)
    with pa.OSFile(f"{tmp_path}/f") as file:
        cursor = warc.Cursor(file, 10, len(data))
        assert cursor.take(20) == data[10:30]
        cursor.skip(500_000)
        assert cursor.peek(400_000) == data[500_030:900_030]
        cursor.skip(399_990)
        assert cursor.take(500_000) == data[900_020:]
        assert cursor.at == len(data)
