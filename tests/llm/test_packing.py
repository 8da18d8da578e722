from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.common import load
from tidemark.llm.queries import QUERIES

PATH = packing.default_vocabulary()
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, docs, tokenizer, capacity=2048):
    """Every id of every document in one piece, sequences full and without gaps."""
    want = Counter()
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.update((doc, k, x, len(ids)) for k, x in enumerate(ids))
    got = Counter()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length > 0
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        got.update((r.doc_id, r.start + k, x, r.doc_tokens) for k, x in enumerate(ids))
    assert got == want
    assert sorted(ends) == list(range(len(ends)))
    assert max(ends.values(), default=0) <= capacity
    return len(ends) * capacity - sum(ends.values())


def test_special_texts(spark, clashing, tokenizer):
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "Don't WE'LL 12.5%% a\xa0b"), (5, "İ Σ ΑΣ 日本 ß"),
        (6, "a<|endoftext|>b \x01 c\x00d"), (7, "word " * 9000), (8, "é é ½ª"), (None, "no id"),
        (9, "same"), (9, "same"),
    ]
    df = clashing(spark.createDataFrame(docs, SCHEMA))
    assert check(packing.pack(df, PATH).collect(), docs, tokenizer) < 2048


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_whole_table(spark, data, tokenizer):
    source = load(spark, data, "documents").select("doc_id", "text")
    docs = [tuple(r) for r in source.collect()]
    padding = check(packing.pack(source, PATH).collect(), docs, tokenizer)
    assert padding < 0.01 * 2048 * len(docs)
    digests = QUERIES["op3_packing"](spark, data).columns
    assert digests == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12), st.integers(0, 5))
def test_plan_places_each_piece_once(counts, slack):
    filled, seen = Counter(), Counter()
    for origin, low, high, begin, part, first, k, i, at in packing.pack_lengths(counts, 40, slack):
        for rank in range(low, high):
            index = i + rank - low
            filled[first + index // k] += part
            seen.update((origin, rank, begin + x) for x in range(part))
    assert seen == Counter({(n, r, x): 1 for n, c in counts.items() for r in range(c) for x in range(n)})
    assert sorted(filled) == list(range(len(filled)))
    assert all(n <= 40 for n in filled.values())
    assert sum(40 - n > slack for n in filled.values()) <= 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(1, 60))
def test_fill_is_the_closest_subset_sum(counts, room):
    used = packing._fill(counts, room)
    assert all(used[n] <= counts[n] for n in used)
    sums = {0}
    for n, c in counts.items():
        sums |= {s + n * k for s in sums for k in range(1, c + 1)}
    assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)
