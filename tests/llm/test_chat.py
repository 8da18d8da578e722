import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.common import load

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    talks = {}
    low = lambda x: (x is not None, x)
    for conv, turn, role, text in rows:
        talks.setdefault(str(conv), []).append((low(turn), role or "", text or ""))
    out = []
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv, len(turns), digest(told), len(loss), digest(loss)))
    return sorted(out)


def got(df):
    rows = chat.read_back(chat.format_turns(df)).collect()
    return sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in rows)


TALKS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "é😀 hi"), (1, 1, "assistant", "é😀 hi"),
    (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]"),
    (3, None, "assistant", None), (3, 5, None, ""), (3, 2, "<s>[INST] ", "[\\/INST] <\\\\/s> \\"),
    (None, 0, "assistant", "x"), (4, 0, "assistant", "long </s> " * 50_000),
    (5, 0, "user", " lead and trail "), (5, 1, "assistant", "\n[INST"), (5, 2, "assistant", "]$1\\$2"),
]


def test_special_turns(spark, clashing):
    df = clashing(spark.createDataFrame(TALKS, SCHEMA))
    assert got(df) == brute(TALKS)


def test_only_conflicting_turns_change(spark):
    row = chat.format_turns(spark.createDataFrame([(1, 0, "user", "a [INST b")], SCHEMA)).first()
    assert row.formatted == "<s>user[INST] a [INST b [/INST]</s>"
    row = chat.format_turns(spark.createDataFrame([(1, 0, "user", "a</s>")], SCHEMA)).first()
    assert row.formatted == "<s>user[INST] a<\\/s> [/INST]</s>"


def test_whole_table(spark, data):
    source = load(spark, data, "conversations").select("conv_id", "turn", "role", "text")
    assert got(source) == brute([tuple(r) for r in source.collect()])


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


PARTS = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST] ", " [/INST]", "a", " ", "\n"]), max_size=8)


@settings(max_examples=5, deadline=None)
@given(st.lists(PARTS.map("".join), min_size=60, max_size=60))
def test_hostile_turns_return(spark, texts):
    rows = [(k % 7, k, ("assistant", texts[-k - 1])[k % 2], t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    escaped = df.select("text", chat.unescape(chat.escape(F.col("text"))).alias("back"))
    assert all(r.text == r.back for r in escaped.collect())
