"""Merkle manifest against a plain tree built in memory."""

import hashlib
import zlib

import pytest

from tidemark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def damaged(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 2:
        return row
    return (*row[:4], row[4].replace("\n", ""))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 3])) for i in range(0, len(low), 3)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        low = at - at % 3
        found.append((level[low:at], level[at + 1 : low + 3]))
        at //= 3
    return found


def by_hand(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in names}
    trees = {s: tree([leaf(r) for r in order[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    for place, s in enumerate(names):
        for at, row in enumerate(order[s]):
            path = siblings(trees[s], at) + siblings(top, place)
            folded = leaf(damaged(row))
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            root = top[-1][0]
            yield (row[0], leaf(row), trees[s][-1][0], root, proof, folded, folded == root)


def same(df, rows):
    key = lambda r: tuple(str(v) for v in r)
    got = merkle.audit_damaged(df).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    assert sorted(map(tuple, got.collect()), key=key) == sorted(by_hand(rows), key=key)


ODD = [
    (5, "b", "en", 3, "a\nb"),
    (5, "b", "en", 3, "a\nb"),
    (5, "b", "en", 3, "other\n\n"),
    (-7, "b", None, None, None),
    (None, "b", "en", 0, ""),
    (None, "b", "en", 1, "x\n"),
    (None, "b", "en", 1, "x\n"),
    (2**62, "b", "de", 1, "\n"),
    (-(2**63), "b", "de", 1, "é\n"),
    (63, "b", "de", 1, "w"),
    (64, None, "de", 1, "null source\n"),
    (64, "", "de", 1, "empty source\n"),
    (1, "é", "-", 2, "5:x\n" * 50_000),
    (2, "z", "-", 2, "lone"),
]


def test_odd_rows(spark, clashing):
    same(clashing(spark.createDataFrame(ODD, SCHEMA)), ODD)


def test_heavy_ids_are_looked_up_alike(spark, monkeypatch):
    rows = [*ODD, *((9, "b", "en", i % 3, f"t{i % 40}\n") for i in range(200)), (10, "b", "", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    same(df, rows)
    monkeypatch.setattr(merkle, "HEAVY_ROWS", 5)
    same(df, rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, merkle.ARRAY, merkle.ARRAY + 1])
def test_sizes_of_one_source(spark, n):
    rows = [(i * 1000, "s", "en", i, f"{i}\n") for i in range(n)]
    same(spark.createDataFrame(rows, SCHEMA), rows)


def test_long_run_of_equal_rows(spark):
    rows = [(1, "s", "en", 1, "one")] + [(2, "s", "en", 1, "same\n")] * 5000 + [(3, "s", "en", 1, "three")]
    same(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_many_sources(spark):
    rows = [(i, f"s{i % 700}", "en", i, f"{i}") for i in range(900)]
    same(spark.createDataFrame(rows, SCHEMA), rows)


def test_empty_table(spark):
    assert merkle.audit_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
    assert merkle.build(spark.createDataFrame([], SCHEMA)).root is None


def test_paths_lead_to_the_root(spark):
    made = merkle.build(spark.createDataFrame(ODD, SCHEMA))
    for row in merkle.audit(made, with_paths=True).collect():
        assert row["verified"]
        assert merkle.fold(row["leaf"], merkle.read_path(row["path"])) == made.root
