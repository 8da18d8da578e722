"""Fitting reads sampled texts to their end."""

import pyarrow as pa
from test_learners import fold

from tidemark.llm import language, toxicity


def test_language_counts_reach_the_end():
    texts = ["a" * 30_000 + " tail tail", "b" * language.FIT_CHARS, "tail"]
    batch = pa.record_batch({"text": texts, "lang": ["x"] * 3})
    want = language._hashes(language._text_letters("tail"), 4)[1:2].view("int64")[0]
    out = [r for b in language._count_ngrams(iter([batch])) for r in b.to_pylist()]
    assert sum(r["n"] for r in out if r["size"] == 4 and r["gram"] == want) == 3


def test_toxic_words_reach_the_end():
    start = " ".join(f"w{i}" for i in range(12_000))
    ids = [i for i in range(200) if fold(i)][:60]
    rows = [(i, f"{start} n{i} " + f"you blorgit m{i} " * 1500, "x") if k % 2 else (i, f"ok{i} good{i} thing{i} x{i}", "x") for k, i in enumerate(ids)]
    batch = pa.record_batch({"text": [r[1] for r in rows], "toxic": [k % 2 for k in range(60)]})
    terms = {r["term"]: r["bad"] for b in toxicity._count_terms(iter([batch])) for r in b.to_pylist()}
    assert terms["blorgit"] == 30
