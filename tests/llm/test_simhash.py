import random

import numpy as np
import xxhash

from tidemark.llm import simhash
from tidemark.llm.common import connected_components, load

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = []
    word = ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(docs):
    prints = [plain_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(docs, prints)))


def test_documents_match_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in load(spark, data, "documents").select("doc_id", "text").collect()]
    got = simhash.near_duplicates(load(spark, data, "documents")).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == brute(docs)


def test_special_texts(spark, clashing):
    draw = random.Random(3)
    long = " ".join(draw.choice("abcdefgh") * draw.randint(1, 4) for _ in range(120_000))
    docs = [(5, None), (4, ""), (9, " \n\t"), (1, "One"), (2, "one two"), (3, "ONE TWO"), (7, long), (6, long + " x"), (8, "é\xa0É b c d")]
    df = clashing(spark.createDataFrame(docs, SCHEMA))
    got = simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == brute(docs)
    assert sorted(r.doc_id for r in got if r.kept) == sorted({r.component_id for r in got})


def test_all_pairs_within_three_bits_share_an_anchor(spark):
    draw = random.Random(5)
    values = []
    for _ in range(40):
        x = draw.getrandbits(64)
        y = x
        for bit in draw.sample(range(64), 3):
            y ^= 1 << bit
        values += [x, y]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    anchors = {}
    for r in simhash.to_anchors(df).collect():
        anchors.setdefault(r.fp, {})[r.anchor] = r.home
    for x, y in zip(signed[::2], signed[1::2]):
        shared = anchors[x].keys() & anchors[y].keys()
        assert any(anchors[x][a] or anchors[y][a] for a in shared)
    assert max(map(len, anchors.values())) <= 2 * 17


def test_large_group_of_near_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(
        "tidemark.llm.simhash.in_blocks",
        lambda *a: __import__("tidemark.llm.common", fromlist=["x"]).in_blocks(*a, limit=7),
    )
    values = [1 << a | 1 << b for a in range(12) for b in range(a)] + [(1 << 50) - 1]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = {r.node: r.label for r in connected_components(links).collect()}
    assert got == {v: min(values) for v in values[:-1]}


def test_keep_first_keeps_one_row_of_each_group(spark, clashing):
    same = "the quick brown fox jumps over the lazy dog again"
    docs = [(3, same), (1, same), (1, same), (2, "something else entirely to read here"), (None, "only me"), (None, None), (8, "")]
    df = clashing(spark.createDataFrame(docs, SCHEMA))
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    rows = sorted((str(r[0]), str(r[1])) for r in kept.collect())
    assert rows == [("1", same), ("2", docs[3][1]), ("8", ""), ("None", "only me")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0


def test_components_of_a_long_chain(spark):
    n = 200
    order = np.random.default_rng(1).permutation(n).tolist()
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(900, 901)], "a long, b long")
    got = {r.node: r.label for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 900: 900, 901: 900}
