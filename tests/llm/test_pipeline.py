import corpus_pipeline
from test_packing import PATH

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, language, simhash, toxicity
from tidemark.llm.common import load


def test_stages_take_effect_in_order(spark, data, tmp_path):
    """Each stage against plain Python on its own input."""
    docs = load(spark, data, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        path = str(tmp_path / name)
        result = stage(spark, docs, data)
        assert result.columns == docs.columns
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        assert all(after[k] == before[k] for k in after)
        want = expected(spark, data, name, before)
        assert set(after) == want, name
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.run(spark, data).collect()
    tokenizer = Tokenizer.from_file(PATH)
    got = {}
    for r in sorted(packed, key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, dtype="<u4").tolist())
    assert got == {k: tokenizer.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}


def expected(spark, data, name, rows):
    if name == "language":
        return {k for k, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    if name == "toxicity":
        docs = spark.createDataFrame(list(rows.values()), load(spark, data, "documents").schema)
        grammar = toxicity.fit(docs, load(spark, data, "labels"))
        return {k for k, r in rows.items() if toxicity.score_texts([r.text], grammar)[0] < 0.5}
    if name == "near_duplicates":
        ids = sorted(rows)
        prints = np.array([simhash.fingerprint_bits(rows[k].text) for k in ids], dtype=np.uint64)
        root = np.arange(len(ids))
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
        for _ in ids:
            new = np.array([root[n].min() for n in near])
            if (new == root).all():
                break
            root = new
        return {ids[r] for r in root}
    from test_decontaminate import brute

    items = [(r.item_id, r.text) for r in load(spark, data, "benchmark").collect()]
    return {int(d) for d, *_, hit in brute([(k, r.text) for k, r in rows.items()], items) if not hit}


def test_language_model_is_learnt_from_the_stage_s_input(spark, data):
    docs = load(spark, data, "documents")
    assert set(language.fit(docs.where("lang <> 'de'")).languages) == {"en", "es", "fr"}
    assert decontaminate.WINDOW_WORDS == 10
