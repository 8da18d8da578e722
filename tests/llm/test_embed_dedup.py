import numpy as np
import pytest

from tidemark.llm import embed_dedup
from tidemark.llm.common import load

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, vectors, cosine=0.95):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for v in vectors
    ]
    n = len(ids)
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], dtype=float), np.array(vectors[j], dtype=float)
                near[i, j] = near[j, i] = a @ b >= cosine * np.linalg.norm(a) * np.linalg.norm(b)
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in np.flatnonzero(near[i]))]) for i in range(n)]
        if new == root:
            break
        root = new
    least = {}
    for i in range(n):
        least[root[i]] = min(ids[i], least.get(root[i], ids[i]))
    return {(ids[i], int(near[i].sum()), least[root[i]]) for i in range(n)}


def near_copies(seed=1, dim=24):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((12, dim))
    rows = []
    for i in range(12):
        for _ in range(6):
            rows.append(base[i] * draw.uniform(0.5, 2) + draw.normal(0, 0.12, dim))
    rows += [base[0]] * 15 + [-base[0]]
    return [[float(np.float32(x)) for x in r] for r in rows]


def test_matches_brute_force(spark, clashing):
    vectors = near_copies() + [None, [], [0.0] * 24, [1.0, None], [float("nan")] * 24, [1.0, 2.0], [2.0, 4.0]]
    ids = list(range(100, 100 + len(vectors)))
    df = clashing(spark.createDataFrame([(i, v, 0) for i, v in zip(ids, vectors)], SCHEMA))
    rows = embed_dedup.near_duplicates(df).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in rows} == brute(ids, vectors)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_large_bucket_is_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.common.BLOCK_ROWS", 5)
    monkeypatch.setattr(
        "tidemark.llm.embed_dedup.in_blocks",
        lambda *a, **k: __import__("tidemark.llm.common", fromlist=["x"]).in_blocks(*a, limit=5, **k),
    )
    vectors = near_copies(2)
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, vectors)], SCHEMA)
    got = {(r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert got == brute(ids, vectors)


def test_repeated_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, [0.0, 1.0], 0)], SCHEMA)
    rows = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in embed_dedup.near_duplicates(df).collect())
    assert rows == [("1", 2, "1"), ("1", 2, "1"), ("None", 0, "None"), ("None", 2, "1")]


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [10, 50_000, 10**9])
def test_threshold_pairs_meet(n):
    width, tables = embed_dedup.table_plan(n)
    near = embed_dedup.agreement((2 - 2 * 0.95) ** 0.5) ** width
    assert (1 - near) ** tables <= 1e-3


def test_whole_table(spark, data):
    source = load(spark, data, "embeddings")
    rows = source.collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = {(r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(source).collect()}
    assert got == want
