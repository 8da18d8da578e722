"""Language identification and toxicity: held-out accuracy and special rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, toxicity
from tidemark.llm.common import load

SCHEMA = "doc_id long, text string, lang string"


def fold(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 5


def test_language_on_held_out_documents(spark, data):
    docs = load(spark, data, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (fold(r.doc_id) == 0) for r in found)
    held = [r.lang == r.lang_pred for r in found if r.held_out]
    assert np.mean(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_special_texts(spark, clashing, data):
    model = language.fit(load(spark, data, "documents"))
    texts = [None, "", " 12 .. %", "the of and to " * 50_000, "日本", "ж"]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "the and", "en"), (None, "the and", "en")]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = language.identify(df, model).collect()
    assert [r.lang_pred for r in got[:4]] == ["und", "und", "und", "en"]
    assert got[4].score == got[5].score == 0 and len(got) == len(rows)
    kept = language.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3


def test_language_without_labels_or_rows(spark):
    none = spark.createDataFrame([(1, "some text", None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.identify(none).collect()] == [("und", 0.0)]
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scores_match_one_look_up_at_a_time(spark, data):
    """The batched scores equal n-gram sets looked up one by one."""
    docs = load(spark, data, "documents")
    model = language.fit(docs)
    texts = [r.text for r in docs.limit(20).collect()]
    names, scores = language.score_texts(texts, model)
    for text, name, score in zip(texts, names, scores):
        letters = language._text_letters(text)
        total = np.zeros(len(model.languages))
        for size in language.NGRAMS:
            hashes = language._hashes(letters, size)
            for bit in range(len(model.languages)):
                hit = np.ones(len(hashes), dtype=bool)
                for k in range(language.HASHES):
                    hit &= (model.planes[size][bit // 8][language._slot(hashes, k)] >> bit % 8 & 1) == 1
                f = model.false[size][bit]
                total[bit] += max(0, (hit.sum() - len(hashes) * f) / (1 - f))
        assert name == model.languages[int(np.argmax(total))]
        assert score == pytest.approx(total.max() / total.sum())


def test_many_languages_need_more_planes(spark):
    rows = []
    for k in range(11):
        letters = "".join(chr(97 + (k * 7 + j) % 26) for j in range(6))
        rows += [(100 * k + j, f"{letters} {letters[::-1]} {letters[2:]}", f"l{k:02}") for j in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = language.identify(docs).join(docs, "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_toxicity_on_held_out_documents(spark, data):
    docs, labels = load(spark, data, "documents"), load(spark, data, "labels")
    found = toxicity.score_documents(docs, labels)
    rows = found.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert np.mean([r.toxic == r.predicted for r in rows]) > 0.9
    assert found.count() == docs.count()
    # Labels, languages and sources are no inputs: a model scores rows without them alike.
    grammar = toxicity.fit(docs, labels)
    bare = docs.select("doc_id", "text", F.lit("zz").alias("lang"))
    assert sorted(map(tuple, toxicity.score_documents(bare, labels.limit(0), grammar).collect())) == sorted(
        map(tuple, toxicity.score_documents(docs, labels, grammar).collect())
    )


def test_clauses_tell_kinds():
    grammar = toxicity.Grammar(frozenset({"idiot"}), frozenset({"scumm"}), tuple(toxicity.PRIOR))
    kinds = lambda t: dict(zip(toxicity.KINDS, toxicity.clause_counts(t, grammar)))
    assert kinds("What an idiot.")["plain"] == 1
    assert kinds("You are an IDIOT, scummy")["targeted"] == 2
    assert kinds("this is not an idiot")["negated"] == 1
    assert kinds("They said idiot")["reported"] == 1
    assert kinds("I will kill you")["threat"] == 1
    assert kinds("I will not kill you")["threat"] == 0
    assert sum(kinds("videoidiot idiotic. kill time").values()) == 0
    score = lambda t: toxicity.score_texts([t], grammar)[0]
    assert score("you idiot") > score("idiot") > 0.5 > score("not an idiot") > score("fine")


def test_toxicity_of_special_texts(spark, clashing, data):
    docs, labels = load(spark, data, "documents"), load(spark, data, "labels")
    grammar = toxicity.fit(docs, labels)
    rows = [(1, None, "x"), (2, "", "x"), (3, "fine words " * 100_000 + "idiot moron scum", "x"), (None, "ok", "x"), (4, "idiot", "x"), (4, "idiot", "x")]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = toxicity.score_documents(df, labels, grammar).collect()
    assert [r.predicted for r in got] == [0, 0, 1, 0, 1, 1]
    kept = toxicity.keep_clean(df, labels, grammar)
    assert kept.columns == df.columns and kept.count() == 3


def test_toxicity_without_labels_or_rows(spark, data):
    docs = load(spark, data, "documents")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, none).where("predicted = 1").count() == 0
    assert toxicity.score_documents(docs.limit(0), load(spark, data, "labels")).count() == 0


def test_samples_are_drawn_from_tables_of_any_size():
    from tidemark.llm.common import DRAW_BITS, share_bound

    for wanted, n in ((2000, 10**10), (20_000, 10**13), (2000, 1), (2000, 0), (2000, 1500)):
        share = share_bound(wanted, n) / 2**DRAW_BITS
        assert share * max(n, 1) == pytest.approx(min(wanted, max(n, 1)), rel=1e-6)
    assert share_bound(5, 5) == 2**DRAW_BITS
