"""SimHash near-duplicates by anchor-point covering.

A fingerprint of 64 bits is two halves of 32. Two fingerprints that differ in at most
three bits differ in at most one bit of one half. Anchors of a half are the words of
the perfect Hamming code of length 31 with one free bit added: every half lies within
one bit of an anchor (covering radius 1), so halves that differ in at most one bit
share an anchor within two bits. Each fingerprint is sent to all anchors within two
bits of each half (17 at most) and compared there with the exact distance. Nothing is
missed, and 2^27 anchors a half keep unrelated fingerprints apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import (
    Carried,
    connected_components,
    in_blocks,
    pick,
    sorted_groups,
    spanning_links,
    stage_once,
    text_slices,
)

SHINGLE_WORDS = 3  # fixed value
SEED = 42  # fixed value
MAX_BITS = 3  # fixed value
CHUNK_SHINGLES = 1 << 15  # hashed at a time, so that a long text needs little memory

# Masks whose parities are the syndrome of a 31-bit word: bit p-1 stands for place p.
_CHECKS = [sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1) for j in range(5)]


def _flips(syndrome: int) -> list[int]:
    """What to change in a half with this syndrome to reach each anchor within two bits."""
    place = lambda p: 1 << (p - 1)
    if syndrome == 0:
        return [0, 1 << 31]
    pairs = [place(i) | place(i ^ syndrome) for i in range(1, 32) if i < i ^ syndrome]
    return [place(syndrome), *pairs, place(syndrome) | 1 << 31]


def fingerprint_bits(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    width = min(width, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, CHUNK_SHINGLES):
        high = min(n, low + CHUNK_SHINGLES)
        hashes = np.fromiter(
            (digest(joined[starts[i] : starts[i + width] - 1], SEED) for i in range(low, high)),
            dtype=np.uint64,
            count=high - low,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint(texts: pa.Array) -> pa.Array:
    every = (fingerprint_bits(t) for part in text_slices(texts) for t in part)
    return pa.array(np.fromiter(every, dtype=np.uint64, count=len(texts)).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) for every document; null text gives zero."""
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.arrow_udf(_fingerprint, LongType())("text").alias("fp")
    )


def to_anchors(prints: DataFrame) -> DataFrame:
    """Each ``fp`` at every anchor in reach: ``anchor`` (half and code word), ``home``."""
    table = F.array(*(F.array(*(F.lit(x) for x in _flips(s))) for s in range(32)))

    def half(number: int) -> DataFrame:
        bits = F.shiftrightunsigned("fp", 32 * number).bitwiseAND(F.lit(0xFFFFFFFF))
        syndrome = F.lit(0)
        for j, mask in enumerate(_CHECKS):
            parity = F.bit_count(F.col("half").bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))
            syndrome = syndrome + F.shiftleft(parity, j)
        return (
            prints.select("fp", bits.alias("half"))
            .withColumn("s", syndrome)
            .select("fp", "half", F.posexplode(F.element_at(table, F.col("s") + 1)))
            .select(
                (F.col("half").bitwiseXOR(F.col("col").cast("long")) * 2 + number).alias("anchor"),
                "fp",
                (F.col("pos") == 0).alias("home"),
            )
        )

    return half(0).union(half(1))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of the fingerprints at each anchor that is someone's home."""
    for table, starts in sorted_groups(batches, 3):
        prints = table.column(3).to_numpy().view(np.uint64)
        home = table.column(4).to_numpy(zero_copy_only=False)
        sizes = np.diff(starts)
        a, b = [], []
        for k in np.flatnonzero(sizes > 1):
            low, high = int(starts[k]), int(starts[k + 1])
            if not home[low:high].any():
                continue
            own = np.unique(prints[low:high])

            def near(i: int, left: np.ndarray, own: np.ndarray = own) -> np.ndarray:
                return np.bitwise_count(own[i] ^ own[left]) <= MAX_BITS

            for i, j in spanning_links(len(own), near):
                a.append(own[i])
                b.append(own[j])
        if a:
            yield pa.record_batch(
                {
                    "a": np.array(a, dtype=np.uint64).view(np.int64),
                    "b": np.array(b, dtype=np.uint64).view(np.int64),
                }
            )


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fp`` that connect all pairs within three bits.

    Within an anchor only a spanning forest of the near pairs comes out, so a large group
    of near copies gives as many rows as it has members, not their square. Anchors with
    many fingerprints are dealt out over blocks (:func:`common.in_blocks`).
    """
    sent = in_blocks(to_anchors(prints), ["anchor"], "fp")
    blocks = (
        sent.select("anchor", "block_a", "block_b", "fp", "home")
        .repartition("anchor", "block_a", "block_b")
        .sortWithinPartitions("anchor", "block_a", "block_b")
    )
    return blocks.mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint``, ``component_id``, ``kept``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever
    their names. Null, empty and blank texts have fingerprint zero and link like
    any other. Repeated rows come back as often as given. A null ``doc_id`` links
    its documents but is never a component's id, unless all its members are null, where
    the id is null. An empty table gives an empty result. ``kept`` marks the
    rows with the component's smallest ``doc_id``.
    """
    prints = stage_once(fingerprints(docs), "fingerprints")
    return prints.join(components(prints), "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        (F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("has_first")).alias("kept"),
    )


def components(prints: DataFrame) -> DataFrame:
    """``fp``, ``component_id``, ``has_first`` for each distinct ``fp`` of staged ``doc_id``, ``fp``.

    ``has_first`` is true for one fingerprint of each component, one that the smallest
    document has.
    """
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = connected_components(near_links(classes.select("fp")))
    labelled = classes.join(nodes, classes["fp"] == nodes["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    order = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp")
    first = labelled.groupBy("label").agg(F.min(order).alias("first"))
    return labelled.join(first, "label").select(
        "fp",
        F.col("first.first_id").alias("component_id"),
        (F.col("first.fp") == F.col("fp")).alias("has_first"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the smallest ``doc_id``.

    All columns stay as they are. Of repeated rows with that id one stays. Cases as
    in :func:`near_duplicates`. The texts are staged once with their fingerprints, and
    shuffled once to meet the ids that stay.
    """
    carried = Carried(docs)
    text, doc_id = carried.name("text"), carried.name("doc_id")
    marked = stage_once(
        carried.plain.withColumn("fp", F.arrow_udf(_fingerprint, LongType())(text)), "marked"
    )
    kept = (
        components(marked.select(F.col(doc_id).alias("doc_id"), "fp"))
        .where("has_first")
        .select(F.col("fp").alias("kept_fp"), F.col("component_id").alias("kept_id"))
    )
    same = (marked["fp"] == kept["kept_fp"]) & marked[doc_id].eqNullSafe(kept["kept_id"])
    one = Window.partitionBy("fp", doc_id).orderBy(F.xxhash64(text))
    left = marked.join(kept, same, "left_semi").withColumn("copy", F.row_number().over(one))
    return carried.back(left.where("copy = 1"))
