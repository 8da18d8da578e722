"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ranked

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(f"[^{ranked.NOT_TERM}]+", lower)


def by_hand(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_words = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    queries = {}
    for item, text in set(items):
        queries.setdefault(item, Counter()).update(terms(text))
    for item, query in queries.items():
        scored = []
        for doc_id, counts in counted:
            m = 25 + 75 * counts.total() * n_docs // max(n_words, 1)
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, q in query.items() if counts[t]
            )
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        for place, (score, known, doc_id) in enumerate(sorted(scored)[:top], 1):
            yield item, place, doc_id if known else None, -score


def same(spark, docs, items, extra=lambda df: df, parts=3, **options):
    found = ranked.search(
        extra(spark.createDataFrame(docs, DOCS).repartition(parts)),
        extra(spark.createDataFrame(items, ITEMS)),
        **options,
    )
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(by_hand(docs, items, **options), key=key)


def words(rng, n, vocabulary):
    return " ".join(rng.choices(vocabulary, k=n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(300)]
    docs = [(i, words(rng, rng.randint(0, 80), vocabulary)) for i in range(1500)]
    items = [(i, words(rng, rng.choice([1, 3, 20, 90, 200]), vocabulary)) for i in range(25)]
    return docs, items


def test_same_as_scoring_all(spark, corpus):
    same(spark, *corpus)
    same(spark, *corpus, parts=1, top=3)


def test_passes_and_small_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranked, "PASS_TERMS", 100)
    monkeypatch.setattr(ranked, "BLOCK_CELLS", 900)
    same(spark, corpus[0][:300], corpus[1])


def test_odd_rows(spark, clashing):
    docs = [
        (1, "Éa éa x9 X9, x9"), (1, "Éa éa x9 X9, x9"), (2, None), (3, ""), (4, "... !"),
        (None, "x9 alone"), (None, "x9 alone"), (5, "x9 alone"), (6, "日本 語"), (7, "rare " * 400_000),
        *((100 + i, "same text x9") for i in range(40)),
    ]
    items = [
        (1, "x9 X9"), (1, "x9 X9"), (1, "alone"), (None, "日本"), (2, None), (3, "?"), (4, "nowhere"),
        (5, "rare éa"), (6, "same"),
    ]
    same(spark, docs, items, extra=clashing)


def test_empty_tables(spark):
    same(spark, [], [(1, "a")])
    same(spark, [(1, "a")], [])
    same(spark, [(1, None)], [(1, "a")])


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(ranked, "PIECE", 7)
    text = "abc defghij kl mnopqrstuvw xyz  ABC é1 " * 20
    assert ranked.count_terms(text.encode()) == Counter(t.encode() for t in terms(text))


def test_groups_are_the_distinct_masks():
    rng = np.random.default_rng(3)
    for n_terms in (1, 8, 64, 65, 200):
        present = rng.random((n_terms, 50)) < 0.05
        first, group = ranked.mask_groups(present)
        columns = [bytes(c) for c in present.T]
        assert len(first) == len(set(columns))
        assert all(columns[first[g]] == c for g, c in zip(group, columns))


def test_few_documents_are_scored(corpus, monkeypatch):
    """Groups whose bound is below the worst of the best are left out."""
    import pyarrow as pa

    docs, _ = corpus
    counted = [ranked.count_terms(t.encode()) for _, t in docs]
    places = {b"w1": 0, b"w2": 1, b"w7": 2}
    ids = [[places[t] for t in c if t in places] for c in counted]
    tfs = [[c[t] for t in c if t in places] for c in counted]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _ in docs], pa.int64()),
            pa.array([c.total() for c in counted], pa.int64()),
            pa.array(ids, pa.list_(pa.int32())),
            pa.array(tfs, pa.list_(pa.int32())),
        ],
        ["doc_id", "n", "ids", "tfs"],
    )
    block = ranked.Block(batch, 3, len(docs), sum(c.total() for c in counted))
    query = ranked.Query(np.array([0, 1, 2]), np.array([10, 500, 40_000]))
    monkeypatch.setattr(ranked, "TRIED", 4)
    scored = []
    product = ranked._product
    monkeypatch.setattr(ranked, "_product", lambda w, i, m: (scored.append(i.shape[1]), product(w, i, m))[1])
    best = ranked.best_of_block(block, query, [], 10)
    assert len(best) == 10
    assert sum(scored[1:]) < len(docs) / 2
