"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Items and documents are cut into the same words; every run of ten words of an item is
a window (a shorter item is one window). The distinct windows are the hash set.
A document's windows are looked up in it by the text of the window itself, so a
hit is verified by equality. Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Carried, pick, stage_once

WINDOW_WORDS = 10
BROADCAST_ROWS = 1_000_000  # windows sent to every task; beyond, the join shuffles

_SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_FROM = string.ascii_uppercase + _SEPARATORS
_TO = string.ascii_lowercase + " " * len(_SEPARATORS)


def words_of(text: Column) -> Column:
    """The words of a text: runs of a-z, 0-9 and non-ASCII after lower-casing A-Z; null has none."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def windows_of(words: Column, size: int) -> Column:
    """Each run of ``size`` words with the place of its first word, from 1."""
    last = F.size(words) - (size - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("start"),
            F.lit(size).alias("length"),
            F.array_join(F.slice(words, i, size), " ").alias("window"),
        ),
    )


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``window``, ``length``, ``items``: each distinct window and the items it occurs in.

    Items without an id have windows, but are not listed.
    """
    words = pick(benchmark, "item_id", "text").select(
        F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")
    )
    width = F.least(F.lit(size), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", width.alias("length"), F.explode(starts).alias("start"))
        .select("item", "length", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("window"))
        .groupBy("window", "length")
        .agg(F.collect_set("item").alias("items"))
    )


def find_hits(
    docs: DataFrame, text: str, benchmark: DataFrame, size: int = WINDOW_WORDS
) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``hit_places``, ``hit_items`` (sorted).

    One scan of the texts: windows are made and looked up in the task that reads them;
    only documents' other columns (keep them few), counts and hits are shuffled.
    """
    wanted = stage_once(benchmark_windows(benchmark, size), "windows")
    facts = wanted.agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("length").alias("lengths")
    ).first()
    lookup = wanted.select("window", "items")
    if facts["n"] <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    # At most `size` lengths exist: the full one and those of items that are shorter.
    lengths = sorted(facts["lengths"])
    none = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("window")))
    others = [c for c in docs.columns if c != text]
    cut = docs.select(
        F.monotonically_increasing_id().alias("row"), *others, words_of(F.col(text)).alias("words")
    )
    windows = F.concat(none, *(windows_of(F.col("words"), k) for k in lengths))
    spread = cut.select(
        "row", *others, F.size("words").alias("n_words"), F.explode(windows).alias("w")
    ).select("row", *others, "n_words", "w.*")
    found = spread.join(lookup, "window", "left").where("start = 0 or items is not null")
    hit = F.when(F.col("start") > 0, F.struct("start", "length"))
    grouped = found.groupBy("row", *others, "n_words").agg(
        F.collect_set(hit).alias("hits"), F.collect_set("items").alias("lists")
    )
    places = F.flatten(
        F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))
    )
    return grouped.select(
        *others,
        "n_words",
        F.array_sort(F.array_distinct(places)).alias("hit_places"),
        F.array_sort(F.array_distinct(F.flatten("lists"))).alias("hit_items"),
    )


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: words, words hit, and the benchmark items found.

    Null, empty and wordless texts have no words and no hits. Items without
    words match nothing; the words that one with a null id matches are hit, but it is not counted or listed. Repeated rows, also of equal ``doc_id``, come
    back as often as given. Columns other than ``doc_id`` and ``text`` are ignored.
    Empty tables on either side give an empty result or no hits. ``hit_places``
    are the places of hit words, from 1.
    """
    found = find_hits(pick(docs, "doc_id", "text"), "text", benchmark, size)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hit_places").cast("long").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_places") > 0).alias("contaminated"),
        "hit_places",
        "hit_items",
    )


def remove(
    docs: DataFrame, benchmark: DataFrame, spans: bool = False, size: int = WINDOW_WORDS
) -> DataFrame:
    """``docs`` without contaminated documents, or with ``spans`` without the hit words.

    The ids and text hashes of contaminated documents are found first and joined back; the
    texts are shuffled only if these are too many to be sent to every task. All columns stay. A cut word takes the separators after it along; texts without hits stay
    byte for byte. Cases as in :func:`report`.
    """
    carried = Carried(docs)
    doc_id, text = carried.name("doc_id"), carried.name("text")
    seen = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    hit = (
        find_hits(seen, "text", benchmark, size)
        .where(F.size("hit_places") > 0)
        .select("doc_id", "text_hash", "hit_places")
        .dropDuplicates(["doc_id", "text_hash"])
    )
    plain = carried.plain.withColumn("own_hash", F.xxhash64(text))
    same = plain[doc_id].eqNullSafe(hit["doc_id"]) & (plain["own_hash"] == hit["text_hash"])
    if not spans:
        return carried.back(plain.join(hit, same, "left_anti"))
    word, gap = "0-9A-Za-z\\x{80}-\\x{10FFFF}", "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"
    lead = F.regexp_extract(text, f"^[{gap}]*", 0)
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"([{word}]+[{gap}]*)"), F.lit(1))
    left = F.filter(pieces, lambda p, i: ~F.array_contains("hit_places", i + 1))
    cut = F.when(F.size("hit_places") > 0, F.concat(lead, F.array_join(left, "")))
    joined = plain.join(hit, same, "left").withColumn("cut_text", F.coalesce(cut, text))
    return carried.back(joined, text="cut_text")
