import re

from tidemark.llm import licenses
from tidemark.llm.common import load

SCHEMA = "doc_id long, text string"


def plain(sentence):
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def cut(text):
    return [p for p in map(plain, re.split(r"\n+|(?<=[.:;!?])\s+", text or "")) if p]


def brute(docs):
    chains = [(name, [p for n in ids for p in cut(licenses.SENTENCES[n])]) for name, ids in licenses.RULES]
    known = {p for s in licenses.SENTENCES.values() for p in cut(s)}
    out = []
    for doc, text in docs:
        own = cut(text)
        hit = [
            (name, chain)
            for name, chain in chains
            if any(own[i : i + len(chain)] == chain for i in range(len(own)))
        ]
        inside = lambda a, b: len(a) < len(b) and any(b[i : i + len(a)] == a for i in range(len(b)))
        names = sorted({n for n, c in hit if not any(inside(c, d) and m != n for m, d in hit)})
        out.append((str(doc), len(own), sum(p in known for p in own), ",".join(names)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_sentences, r.n_known, r.licences) for r in licenses.scan(df).collect())


MIT = "\n\n".join(licenses.SENTENCES[n] for n in (1, 2, 3))
BSD = " ".join(licenses.SENTENCES[n] for n in (17, 18, 19, 20))
DOCS = [
    (1, None), (2, ""), (3, "?!\n..."), (4, "Title\n" + MIT + "\ncode"), (5, BSD), (5, BSD),
    (6, licenses.SENTENCES[1]), (7, "RELEASED under the   mit license"), (8, "x. " * 100_000 + "All rights reserved."),
    (None, "Licensed under CC BY 4.0.\nAll rights reserved."), (9, "Not released under the MIT License."),
    (10, " ".join(licenses.SENTENCES[n] for n in (17, 18, 19))),
]


def test_special_texts(spark, clashing):
    df = clashing(spark.createDataFrame(DOCS, SCHEMA))
    rows = got(df)
    assert rows == brute(DOCS)
    names = {r[0]: r[3] for r in rows}
    assert names["4"] == "MIT" and names["5"] == "BSD-3-Clause" and names["10"] == "BSD-2-Clause"
    assert names["6"] == names["9"] == ""


def test_whole_table(spark, data):
    source = load(spark, data, "documents").select("doc_id", "text")
    assert got(source) == brute([tuple(r) for r in source.collect()])


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
