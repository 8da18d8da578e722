"""Language identification with bit-sliced Bloom filters of character n-grams.

Every slot of a filter holds one bit per language. An n-gram's slots, combined by AND, name
all languages whose filter contains it, in one look-up. A text's score for a
language is the number of its n-grams found there, less the number that its filter would
claim by chance: with a share f of false positives, ``(hits - n f) / (1 - f)``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import DRAW_BITS, Carried, held_out, in_slices, pick, share_bound, text_slices

NGRAMS = (3, 4)  # characters; a gap between words counts as one
SLOTS_LOG2 = 19
HASHES = 2
SAMPLE_DOCS = 2000  # labelled documents read for each language when fitting
FILTER_NGRAMS = 30_000  # most frequent n-grams kept for each language and length
OWN_SHARE = 0.3  # of the largest relative frequency that makes an n-gram a language's own
MAX_LANGUAGES = 4096  # labels a model can hold
SLICE_CHARS = 1 << 18  # scored at a time
FIT_CHARS = 1 << 22  # counted at a time when fitting
UNKNOWN = "und"

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64
) | np.uint64(1)
_SLOTS = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], dtype=np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for low, high in ((0, 0x3400), (0xA000, 0xAC00), (0xF900, 0x20000)):
        for c in range(low, high):
            if unicodedata.category(chr(c))[0] == "L":
                table[c] = ord(chr(c).lower()[0])
    for low, high in ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0x20000, 0x32000)):
        table[low:high] = np.arange(low, high)  # scripts without case
    return table


def _text_letters(text: str) -> np.ndarray:
    """Letters of a text, one 0 for each gap between words and at both ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.concatenate(([np.uint32(0)], _letters()[codes], [np.uint32(0)]))
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    return letters[keep]


def _hashes(letters: np.ndarray, size: int) -> np.ndarray:
    """A number for each n-gram of this size."""
    n = len(letters) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    wide = letters.astype(np.uint64) + np.uint64(1)
    out = wide[:n] * _FACTORS[0]
    for k in range(1, size):
        out += wide[k : k + n] * _FACTORS[k]
        out ^= out >> np.uint64(29)
        out *= _FACTORS[(k + 1) % 4]
    return out


def _slot(hashes: np.ndarray, k: int) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(31))) * _SLOTS[k]) >> np.uint64(64 - SLOTS_LOG2)


class Model(NamedTuple):
    """Languages, their filters (a byte plane for each eight) and false-positive shares, by n-gram size."""

    languages: tuple[str, ...]
    planes: dict[int, np.ndarray]
    false: dict[int, np.ndarray]


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for own in _letter_slices(t for t, x in zip(texts, langs) if x == lang):
                for size in NGRAMS:
                    parts = [_hashes(x, size) for x in own]
                    grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * len(grams), type=pa.string()),
                            "size": np.full(len(grams), size, dtype=np.int32),
                            "gram": grams.view(np.int64),
                            "n": counts.astype(np.int64),
                        }
                    )


def _letter_slices(texts: Iterable[str]) -> Iterator[list[np.ndarray]]:
    """Letters of whole texts, as many at a time as reach ``FIT_CHARS``."""
    held, room = [], FIT_CHARS
    for text in texts:
        held.append(_text_letters(text))
        room -= len(held[-1])
        if room <= 0:
            yield held
            held, room = [], FIT_CHARS
    if held:
        yield held


def fit(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, filter_ngrams: int = FILTER_NGRAMS
) -> Model:
    """Filters of each language's most frequent n-grams, from the rows that are not held out.

    Reads ``doc_id``, ``text`` and ``lang``. At most about ``sample_docs`` rows a language
    are used, chosen by a hash of ``doc_id``; n-grams are counted in Spark and at most
    ``filter_ngrams`` of each length and language reach the driver.
    """
    rows = pick(docs, "doc_id", "text", "lang").where(
        "text is not null and lang is not null"
    ).where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(8), "doc_id"), 64 - DRAW_BITS)
    shares = docs.sparkSession.createDataFrame(
        [(x, share_bound(sample_docs, n)) for x, n in sizes.items()],
        "label string, share long",
    )
    chosen = rows.join(F.broadcast(shares), F.col("lang") == F.col("label")).where(draw < F.col("share"))
    counted = (
        chosen.select("text", "lang")
        .mapInArrow(_count_ngrams, "lang string, size int, gram long, n long")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
    )
    best = _top(counted, filter_ngrams)
    languages = tuple(sorted(sizes))
    planes, false = {}, {}
    width = max(1, -(-len(languages) // 8))
    for size in NGRAMS:
        planes[size] = np.zeros((width, 1 << SLOTS_LOG2), dtype=np.uint8)
        false[size] = np.zeros(len(languages))
    for row in best.collect():
        bit = languages.index(row["lang"])
        grams = np.array(row["grams"], dtype=np.int64).view(np.uint64)
        plane = planes[row["size"]][bit // 8]
        for k in range(HASHES):
            plane[np.unique(_slot(grams, k))] |= np.uint8(1 << bit % 8)
        false[row["size"]][bit] = np.mean(plane >> (bit % 8) & 1) ** HASHES
    return Model(languages, planes, false)


def _top(counted: DataFrame, number: int) -> DataFrame:
    """The most frequent n-grams of each language and length, ties by hash.

    A language whose share of an n-gram is below ``OWN_SHARE`` of the largest owes it to foreign
    passages in its documents, and does not count as containing it.
    """
    every, of_gram = Window.partitionBy("lang", "size"), Window.partitionBy("size", "gram")
    counted = (
        counted.withColumn("rate", F.col("n") / F.sum("n").over(every))
        .withColumn("most", F.max("rate").over(of_gram))
        .where(F.col("rate") >= OWN_SHARE * F.col("most"))
    )
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    return (
        counted.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= number)
        .groupBy("lang", "size")
        .agg(F.collect_list("gram").alias("grams"))
    )


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """The language of each text and its share of the corrected counts."""
    names = [UNKNOWN] * len(texts)
    scores = np.zeros(len(texts))
    if not model.languages:
        return names, scores
    low = 0
    while low < len(texts):
        parts, at = [], low
        room = SLICE_CHARS
        while at < len(texts) and (room > 0 or at == low):
            parts.append(_text_letters(texts[at] or ""))
            room -= len(parts[-1])
            at += 1
        counts = _corrected(parts, model)
        for i, row in enumerate(counts):
            if len(parts[i]) > 1:  # it has a letter
                best = int(np.argmax(row))
                names[low + i] = model.languages[best]
                total = row.sum()
                scores[low + i] = row[best] / total if total > 0 else 0.0
        low = at
    return names, scores


def _corrected(parts: list[np.ndarray], model: Model) -> np.ndarray:
    total = np.zeros((len(parts), len(model.languages)))
    lengths = np.array([len(p) for p in parts])
    letters = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), lengths)
    left = np.concatenate([np.arange(n, 0, -1) for n in lengths])  # letters to the text's end
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    for size in NGRAMS:
        hashes = _hashes(letters, size)
        if not len(hashes):
            continue
        inside = left[: len(hashes)] >= size
        whose = owner[: len(hashes)][inside].astype(np.int64)
        hashes = hashes[inside]
        seen = np.bincount(whose, minlength=len(parts))
        slots = [_slot(hashes, k) for k in range(HASHES)]
        hits = np.zeros((len(parts), 8 * len(model.planes[size])))
        for p, plane in enumerate(model.planes[size]):
            mask = plane[slots[0]]
            for s in slots[1:]:
                mask = mask & plane[s]
            table = np.bincount(whose * 256 + mask, minlength=256 * len(parts))
            hits[:, 8 * p : 8 * p + 8] = table.reshape(-1, 256) @ bits
        false = model.false[size]
        hits = hits[:, : len(model.languages)]
        total += np.maximum(0, (hits - seen[:, None] * false) / (1 - np.minimum(false, 0.999)))
    return total


_RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


def language_of(model: Model, text: str) -> Column:
    """A column with ``lang`` and ``score`` of column ``text``."""

    def predict(texts: pa.Array) -> pa.Array:
        parts = [score_texts(part, model) for part in text_slices(texts)]
        names = [name for own, _ in parts for name in own]
        scores = [score for _, own in parts for score in own.tolist()]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return F.arrow_udf(predict, _RESULT)(text)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    The whole text is scored. Null texts and texts without a letter are ``und`` with score 0,
    and so is everything if no row has a label to learn from. A text none of whose n-grams
    is known goes to the first language with score 0, as do ties. Null ids count as
    held out. Repeated rows come back as often as given; other columns are ignored; an
    empty table gives no rows.
    """
    model = model or fit(docs)
    found = pick(docs, "doc_id", "text").withColumn("found", language_of(model, "text"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` without those of no language (``und``); all columns stay. Learns from ``docs``."""
    model = model or fit(docs)
    carried = Carried(docs)
    found = language_of(model, carried.name("text"))["lang"]
    return carried.back(carried.plain.where(found != UNKNOWN))
