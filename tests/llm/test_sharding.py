import zlib
from collections import defaultdict

from tidemark.llm import sharding
from tidemark.llm.common import load
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def check(rows, docs):
    texts = defaultdict(list)
    for doc, text in docs:
        texts[doc].append((text or "").encode())
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "key"
        assert (r.size - 16, r.text_crc32) in [(len(b), zlib.crc32(b)) for b in texts[r.doc_id]]
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert len(rows) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_special_rows(spark, clashing):
    docs = [(1, None), (2, ""), (3, "é" * 100_000), (4, "a"), (4, "a"), (4, "b"), (None, "a"), (None, None)]
    rows = sharding.assign(clashing(spark.createDataFrame(docs, SCHEMA))).collect()
    check(rows, docs)
    assert len({r.shard for r in rows if r.doc_id == 4}) == len({r.shard for r in rows if r.doc_id is None}) == 1


def test_whole_table(spark, data):
    source = load(spark, data, "documents").select("doc_id", "text")
    check(sharding.assign(source).collect(), [tuple(r) for r in source.collect()])


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).count() == 0


def shards(spark, tree, n=40_000):
    rows = spark.range(n).select("id", sharding.shard_of(tree, F.col("id")).alias("s")).collect()
    return {r.id: r.s for r in rows}


def test_shares_follow_weights(spark):
    tree = [sharding.Leaf(0, 0, 0, 1.0), sharding.Leaf(0, 0, 1, 3.0), sharding.Leaf(0, 1, 2, 2.0), sharding.Leaf(1, 2, 3, 2.0)]
    got = list(shards(spark, tree).values())
    for leaf in tree:
        assert abs(got.count(leaf.shard) / len(got) - leaf.weight / 8) < 0.01


def test_movement_stays_in_subtrees_whose_weight_changes(spark):
    tree = sharding.even_tree(12, 3, 2)
    before = shards(spark, tree)
    heavier = [x._replace(weight=2.0) if x.shard == 5 else x for x in tree]
    region = {x.shard: x.region for x in tree}
    for key, shard in shards(spark, heavier).items():
        if shard != before[key]:
            assert region[shard] == region[5]
    for key, shard in shards(spark, sharding.grown(tree)).items():
        assert shard in (before[key], 12)
