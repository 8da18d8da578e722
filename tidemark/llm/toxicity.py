"""Toxicity scores from a weighted grammar of clauses.

Small transducers each read a clause's words: one for insults and one for threats (their
words are learnt from labelled rows), one for targets, one for negation and one for
reported speech. They are composed into one automaton that walks the clause and says what kind
of statement it holds: a plain, targeted, negated or reported insult or threat. A document
is scored by the kinds of its matched clauses, with weights fitted to the labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from tidemark.llm.common import (
    DRAW_BITS,
    Carried,
    held_out,
    in_slices,
    pick,
    share_bound,
    stage_once,
    text_slices,
)

SAMPLE_DOCS = 20_000  # labelled documents read when fitting
STEMS = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be learnt
SKETCHES = 3  # hash functions that tell near copies in the sample
MIN_EVIDENCE = 30.0  # log-likelihood ratio of a learnt word or beginning
MAX_TERMS = 3000  # words and beginnings kept
NEGATED_WITHIN = 3  # words after a negation that it covers

# Fixed word lists, in English, French, German and Spanish.
TARGETS = set(
    "you your yours you're u they them their he him she her "
    "tu te toi ton ta vous votre vos ils elles "
    "du dich dir dein deine ihr euch euer sie "
    "tú ti tu tus usted ustedes vosotros ellos ellas".split()
)
NEGATIONS = set(
    "not never no isn't aren't wasn't don't doesn't cannot can't nor without "
    "ne pas jamais ni sans nicht kein keine keinen nie niemals ohne no nunca jamás sin".split()
)
REPORTS = set(
    "said says say saying told called calls wrote writes quoted claims claimed reportedly "
    "dit disait déclare appelé écrit sagte sagt sagen nannte schrieb "
    "dijo dice dicen llamó escribió".split()
)
THREATS = set(
    "kill murder shoot stab hurt destroy burn hang beat "
    "tuer tuerai frapper brûler töten umbringen schlagen verbrennen "
    "matar mataré golpear quemar".split()
)

_CLAUSE_END = re.compile(r"[.!?;\n]")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")

KINDS = ("plain", "targeted", "negated", "reported", "threat")
#: Weights before any label is seen: bias, then one for each kind.
PRIOR = np.array([-4.0, 6.0, 7.0, 2.0, 2.0, 5.0])


class Grammar(NamedTuple):
    """Learnt words, word beginnings and the weights of the bias and the clause kinds."""

    words: frozenset[str]
    stems: frozenset[str]
    weights: tuple[float, ...]


@lru_cache(maxsize=4)
def _finder(terms: frozenset[str]) -> ahocorasick.Automaton:
    finder = ahocorasick.Automaton()
    for t in sorted(terms):
        finder.add_word(t, len(t))
    finder.make_automaton()
    return finder


def _insult(word: str, grammar: Grammar) -> bool:
    return word in grammar.words or any(word[:n] in grammar.stems for n in STEMS if n <= len(word))


def _clause_kinds(words: list[str], grammar: Grammar) -> dict[str, int]:
    """Walk a clause once: the state is what was last negated, whether speech is reported,
    and whether someone is addressed; matches are emitted with the state they are met in."""
    negated, reported, target = 0, False, any(w in TARGETS for w in words)
    found: dict[str, int] = {}
    for w in words:
        if w in NEGATIONS:
            negated = NEGATED_WITHIN
            continue
        if w in REPORTS:
            reported = True
        if _insult(w, grammar):
            kind = (
                "reported" if reported else "negated" if negated else "targeted" if target else "plain"
            )
            found[kind] = found.get(kind, 0) + 1
        elif w in THREATS and target and not negated and not reported:
            found["threat"] = found.get("threat", 0) + 1
        negated = max(0, negated - 1)
    return found


def clause_counts(text: str | None, grammar: Grammar) -> list[int]:
    """How many matches of each kind a text has; only clauses with a match are parsed."""
    counts = [0] * len(KINDS)
    if not text:
        return counts
    low = text.lower()
    finder = _finder(grammar.words | grammar.stems | frozenset(THREATS))
    done = -1
    for end, size in finder.iter(low):
        start = end - size + 1
        if start <= done or start and low[start - 1].isalnum():
            continue
        opening = max(low.rfind(c, done + 1, start) for c in ".!?;\n")
        first = max(done + 1, opening + 1)
        closing = _CLAUSE_END.search(low, end + 1)
        done = closing.start() if closing else len(low)
        for kind, n in _clause_kinds(_WORD.findall(low, first, done), grammar).items():
            counts[KINDS.index(kind)] += n
    return counts


def _features(counts: list[list[int]]) -> np.ndarray:
    """A match counts once fully and further ones little, and not by a document's length."""
    n = np.array(counts, dtype=np.float64).reshape(-1, len(KINDS))
    return np.column_stack([np.ones(len(n)), np.minimum(n, 1) + 0.25 * np.log1p(np.maximum(n - 1, 0))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(texts: list[str | None], grammar: Grammar) -> np.ndarray:
    return _sigmoid(_features([clause_counts(t, grammar) for t in texts]) @ np.array(grammar.weights))


# ---------------------------------------------------------------- fitting


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other documents each word and word beginning (with ``*``) is."""
    for batch in in_slices(batches):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(_WORD.findall(text.lower()))
            terms = words | {w[:n] + "*" for w in words for n in STEMS if n < len(w)}
            for t in terms:
                counts.setdefault(t, [0, 0])[1 - int(toxic)] += 1
        yield pa.record_batch(
            {
                "term": pa.array(list(counts), type=pa.string()),
                "bad": pa.array([c[0] for c in counts.values()], type=pa.int64()),
                "good": pa.array([c[1] for c in counts.values()], type=pa.int64()),
            }
        )


def _without_copies(sample: DataFrame) -> DataFrame:
    """One document of each group of near copies: their shared rare words are no evidence.

    A document goes if it shares the smallest hash of its word shingles, for any of
    ``SKETCHES`` hash functions, with another.
    """

    def sketch(texts: pa.Array) -> pa.Array:
        out = []
        for text in (t for part in text_slices(texts) for t in part):
            words = text.encode("utf-8", "surrogatepass").split()
            grams = {b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
            out.append(
                [min(xxhash.xxh64_intdigest(g, k) for g in grams) >> 1 for k in range(SKETCHES)]
            )
        return pa.array(out, pa.list_(pa.int64()))

    marked = sample.select("text", "toxic", F.arrow_udf(sketch, ArrayType(LongType()))("text").alias("s"))
    for k in range(SKETCHES):
        marked = marked.withColumn(f"s{k}", F.col("s")[k])
    for k in range(SKETCHES):
        marked = marked.dropDuplicates([f"s{k}"])
    return marked.select("text", "toxic")


def _choose(rows: list) -> tuple[set[str], set[str]]:
    """The longest beginnings, or words, that lose none of the evidence of shorter ones."""
    evidence = {r["term"]: r["bad"] for r in rows}
    words, stems = set(), set()
    for term in sorted(evidence, key=lambda t: (len(t), t)):
        plain = term.rstrip("*")
        longer = [n for t, n in evidence.items() if t != term and t.startswith(plain)]
        if term.endswith("*") and longer and max(longer) >= 0.9 * evidence[term]:
            continue  # a longer one says the same
        if any(plain[:n] in stems for n in STEMS if n < len(plain)):
            continue  # a shorter one is learnt
        (stems if term.endswith("*") else words).add(plain)
    return words, stems


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Grammar:
    """Learn insults and weights from labelled rows that are not held out.

    At most about ``sample_docs`` labelled rows are read, chosen by a hash of ``doc_id``. Terms are
    counted in Spark; at most ``MAX_TERMS`` of them, and the clause counts of the sample,
    reach the driver. Rows with a null text or label teach nothing; contradictory repeated
    labels each count.
    """
    known = pick(labels, "doc_id", "toxic").where("toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 64 - DRAW_BITS)
    wanted = known.where(draw < share_bound(sample_docs, known.count()))
    texts = pick(docs, "doc_id", "text").where("text is not null")
    sample = stage_once(_without_copies(texts.join(F.broadcast(wanted), "doc_id")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Grammar(frozenset(), frozenset(), tuple(PRIOR))
    expected = (F.col("bad") + F.col("good")) * (bad / (bad + good))
    ratio = 2 * (
        F.col("bad") * F.log(F.col("bad") / expected)
        + F.when(
            F.col("good") > 0,
            F.col("good") * F.log(F.col("good") / (F.col("bad") + F.col("good") - expected)),
        ).otherwise(0.0)
    )
    terms = (
        sample.mapInArrow(_count_terms, "term string, bad long, good long")
        .groupBy("term")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where((F.col("bad") > 0) & (F.col("bad") * good > 20 * bad * F.col("good")))
        .where(ratio >= MIN_EVIDENCE)
        .orderBy(F.desc("bad"), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    words, stems = _choose(terms)
    grammar = Grammar(frozenset(words), frozenset(stems), tuple(PRIOR))
    counted = sample.mapInArrow(_counter(grammar), "counts array<long>, toxic int").groupBy(
        "counts", "toxic"
    )
    rows = counted.count().collect()
    x = _features([r["counts"] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=np.float64)
    n = np.array([r["count"] for r in rows], dtype=np.float64)
    return grammar._replace(weights=tuple(_fit_weights(x, y, n)))


def _counter(grammar: Grammar):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [
                [min(n, 50) for n in clause_counts(t, grammar)] for t in batch.column(0).to_pylist()
            ]
            yield pa.record_batch(
                {
                    "counts": pa.array(counts, type=pa.list_(pa.int64())),
                    "toxic": batch.column(1).cast(pa.int32()),
                }
            )

    return count


def _fit_weights(x: np.ndarray, y: np.ndarray, n: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards ``PRIOR``; kinds never count as good."""
    w = PRIOR.copy()
    for _ in range(30):
        p = _sigmoid(x @ w)
        slope = x.T @ (n * (p - y)) + pull * (w - PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4 / max(1e-9, math.sqrt(step @ step)))
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


# ---------------------------------------------------------------- the operator


def toxicity_of(grammar: Grammar, text: str) -> Column:
    """A column with the score of column ``text``."""

    def score(texts: pa.Array) -> pa.Array:
        parts = [score_texts(part, grammar) for part in text_slices(texts)]
        return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return F.arrow_udf(score, DoubleType())(text)


def score_documents(docs: DataFrame, labels: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    The whole text is scored. Null and empty texts match nothing and get the score of the
    bias alone. Without labels of both kinds the prior weights and the fixed threat words
    are all there is. Null ids count as held out. Repeated rows come back as often as given;
    other columns are ignored; an empty table gives no rows.
    """
    grammar = grammar or fit(docs, labels)
    scored = pick(docs, "doc_id", "text").withColumn("score", toxicity_of(grammar, "text"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """``docs`` without those predicted toxic; all columns stay. Learns from ``docs`` and ``labels``."""
    grammar = grammar or fit(docs, labels)
    carried = Carried(docs)
    return carried.back(carried.plain.where(toxicity_of(grammar, carried.name("text")) < 0.5))
