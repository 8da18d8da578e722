import hashlib
import re

import pytest

from tidemark.llm import decontaminate
from tidemark.llm.common import load

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(own[i : i + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc), len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def rows(report):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in report.collect()
    )


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [
    (1, LONG),
    (2, "Short one"),
    (10, "Short ONE"),
    (3, "...!"),
    (4, None),
    (5, " ".join(f"w{i}" for i in range(5, 16))),
    (None, "alpha beta"),
]
DOCS = [
    (1, None),
    (2, ""),
    (3, "a Short,one-short\x00ONE é"),
    (4, "x " + LONG.upper() + " y"),
    (4, "x " + LONG.upper() + " y"),
    (5, " ".join(f"w{i}" for i in range(9))),
    (6, "w0 " * 5000 + LONG * 2),
    (None, "alpha beta short one"),
    (7, "É short É one Éa"),
]


def test_matches_brute_force(spark, clashing):
    docs = clashing(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = clashing(spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert rows(decontaminate.report(docs, items)) == brute(DOCS, ITEMS)
    alone = spark.createDataFrame([(9, "so alpha BETA")], "doc_id long, text string")
    (row,) = decontaminate.report(alone, items).collect()
    assert (row.n_hit, row.n_items, row.hit_items, row.contaminated) == (2, 0, [], True)


@pytest.mark.parametrize("broadcast", [True, False])
def test_whole_tables(spark, data, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = load(spark, data, "documents"), load(spark, data, "benchmark")
    want = brute(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    assert rows(decontaminate.report(docs, items)) == want


def test_documents_or_spans_go(spark, clashing):
    docs = clashing(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.remove(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r[0]) for r in left.collect()) == ["1", "2", "5", "7"]
    cut = decontaminate.remove(docs, items, spans=True)
    texts = {(str(r[0]), r[1]) for r in cut.collect()}
    assert ("4", "x y") in texts and ("3", "a é") in texts and ("7", DOCS[-1][1]) in texts
    assert cut.count() == len(DOCS)
    assert not any(r.contaminated for r in decontaminate.report(cut, items).collect())


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.n_hit for r in decontaminate.report(docs, none).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.report(empty, spark.createDataFrame(ITEMS, none.schema)).count() == 0
    assert decontaminate.remove(docs, none).count() == len(DOCS)
