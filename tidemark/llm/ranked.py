"""Ranked lexical search: the best documents for each of a set of queries, by presence masks.

Documents are cut into terms once; of each only its length and its query terms are kept. Tasks then
go through blocks of documents. For a query and a block, every term's documents are a row of bits, and the
columns of these rows are the documents' masks of matched terms. Documents with the same mask form a
group, whose highest possible score follows from the mask and each term's highest impact
in the block. Groups are scored by descending bound until the bound falls below the worst of the best
found so far, which a task carries from block to block. What a task returns is its best few per query, so
nothing that is shuffled grows with a document or a query's matches.

Scores are integers and exact. What holds in special cases:

- a null or empty text has no terms and is never found; neither does it count as a document;
- rows of one ``item_id`` (null is an id like any other) form one query of all their terms, equal rows
  counted once; a query without terms, or whose terms occur nowhere, has no result;
- every row is a document of its own; rows of the same score and ``doc_id`` take ranks
  next to each other, and a null ``doc_id`` comes before all others of its score.

Queries are searched together as long as their terms number at most ``PASS_TERMS``; a larger set is
dealt into passes. A single query's terms are always held whole.
"""

from __future__ import annotations

import math
import string
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, pick, stage_once

NOT_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # fixed value: ASCII apart from digits and letters
TOP = 10  # documents per query
PASS_TERMS = 200_000  # terms of the queries searched together
BLOCK_DOCUMENTS = 8192  # documents whose masks are made at once
BLOCK_CELLS = 4_000_000  # but never more than this many terms times documents
TRIED = 256  # documents scored between two looks at the bounds
PIECE = 1 << 20  # bytes of a text split into words at a time
MERGE_GROUPS = 64  # groups in which the tasks' results of a query are first put together

POSTINGS = "doc_id long, n long, ids array<int>, tfs array<int>"
# Separators become spaces and A-Z lower case; bytes of other letters stay.
_FOLD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def count_terms(text: bytes) -> Counter:
    """How often each term occurs in a text (UTF-8)."""
    folded, counts, low = text.translate(_FOLD), Counter(), 0
    while low < len(folded):
        high = folded.find(b" ", low + PIECE)
        high = len(folded) if high < 0 else high
        counts.update(folded[low:high].split())
        low = high
    return counts


def query_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, q``: how often each term occurs in a query."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lower, F.lit(f"[^{NOT_TERM}]+"), F.lit(0))
    return (
        pick(items, "item_id", "text")
        .where("text is not null")
        .distinct()
        .select("item_id", F.explode(found).alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count(F.lit(1)).alias("q"))
    )


def postings(documents: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """Length of each document and its terms among ``places``, with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            lengths, ends, ids, tfs = [], array("i", [0]), array("i"), array("i")
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                counts = count_terms(text or b"")
                lengths.append(counts.total())
                for term in counts.keys() & places.keys():
                    ids.append(places[term])
                    tfs.append(counts[term])
                ends.append(len(ids))
            offsets = pa.array(np.array(ends, np.int32))
            lists = (pa.ListArray.from_arrays(offsets, pa.array(np.array(v, np.int32))) for v in (ids, tfs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(lengths, pa.int64()), *lists],
                ["doc_id", "n", "ids", "tfs"],
            )

    rows = pick(documents, "doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, POSTINGS
    )


def term_weight(n_documents: int, df: int) -> int:
    """Weight of a term that occurs in ``df`` of the documents."""
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Query:
    """Places of a query's terms and their weights times their number in the query."""

    ids: np.ndarray
    weights: np.ndarray


class Block:
    """Documents with their query terms, ordered by term."""

    def __init__(self, batch: pa.RecordBatch, n_terms: int, n_documents: int, n_words: int) -> None:
        self.docs = batch.column(0)
        self.n = batch.num_rows
        lists, tfs = batch.column(2), batch.column(3).flatten().to_numpy()
        ids = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(self.n), np.diff(lists.offsets.to_numpy()))
        # Exact for any length: Python's integers do not overflow.
        m = np.array([25 + 75 * n * n_documents // n_words for n in batch.column(1).to_pylist()], np.int64)
        tfs = tfs.astype(np.int64)
        impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[owner])
        order = np.argsort(ids, kind="stable")
        self.owner, self.impact = owner[order], impact[order].astype(np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=n_terms))])

    def matches(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        """Per term of the query and document: whether it occurs, and its impact."""
        starts = self.starts[query.ids]
        counts = self.starts[query.ids + 1] - starts
        row = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(row)) + np.repeat(starts - np.cumsum(counts) + counts, counts)
        present = np.zeros((len(counts), self.n), dtype=bool)
        impacts = np.zeros((len(counts), self.n), dtype=np.int32)
        present[row, self.owner[at]] = True
        impacts[row, self.owner[at]] = self.impact[at]
        return present, impacts


def mask_groups(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct mask a document that has it; and the mask number of every document."""
    packed = np.packbits(present, axis=0).T
    width = -(-packed.shape[1] // 8) * 8
    words = np.zeros((len(packed), width), dtype=np.uint8)
    words[:, : packed.shape[1]] = packed
    kind = np.uint64 if width == 8 else np.dtype((np.void, width))
    _, first, group = np.unique(words.view(kind).ravel(), return_index=True, return_inverse=True)
    return first, group


def _product(weights: np.ndarray, impacts: np.ndarray, most: int) -> np.ndarray:
    """Exact sums of products, none above ``most``; in doubles, which are faster, where those are exact."""
    if most < 2**53:
        return (weights.astype(np.float64) @ impacts.astype(np.float64)).astype(np.int64)
    return weights @ impacts.astype(np.int64)


def best_of_block(block: Block, query: Query, best: list[tuple], top: int) -> list[tuple]:
    """``best`` with the block's documents: at most ``top`` of ``(-score, has id, id)``, in order."""
    present, impacts = block.matches(query)
    first, group = mask_groups(present)
    highest = query.weights * impacts.max(axis=1, initial=0)
    bounds = _product(highest, present[:, first], int(highest.sum()))
    least = lambda: -best[-1][0] if len(best) == top else 1
    rank = np.empty(len(first), dtype=np.int64)
    order = np.argsort(-bounds, kind="stable")
    rank[order] = np.arange(len(order))
    open_groups = int(np.count_nonzero(bounds >= least()))
    place = rank[group]
    chosen = np.flatnonzero(place < open_groups)
    chosen = chosen[np.argsort(place[chosen], kind="stable")]
    low = 0
    while low < len(chosen) and bounds[order[place[chosen[low]]]] >= least():
        tried = chosen[low : low + TRIED]
        scores = _product(query.weights, impacts[:, tried], int(highest.sum()))
        good = np.flatnonzero(scores >= least())
        ids = block.docs.take(pa.array(tried[good])).to_pylist()
        found = [(-s, d is not None, d or 0) for s, d in zip(scores[good].tolist(), ids)]
        best = sorted([*best, *found])[:top]
        low += TRIED
    return best


def _search(
    rows: DataFrame, queries: list[Query], n_terms: int, n_documents: int, n_words: int, top: int
) -> DataFrame:
    """The best documents of each task: ``item_no, part, doc_id, score``."""
    widest = max(len(q.ids) for q in queries)
    size = max(1, min(BLOCK_DOCUMENTS, BLOCK_CELLS // widest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries]
        for batch in in_slices(batches, size):
            block = Block(batch, n_terms, n_documents, n_words)
            for i, query in enumerate(queries):
                best[i] = best_of_block(block, query, best[i], top)
        part = TaskContext.get().partitionId()
        found = [(i, part, d if known else None, -s) for i, b in enumerate(best) for s, known, d in b]
        columns = list(zip(*found)) if found else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["item_no", "part", "doc_id", "score"]
        )

    return rows.mapInArrow(run, "item_no long, part long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0."""
    spark = documents.sparkSession
    terms = stage_once(query_terms(items), "ranked-terms")
    n_passes = max(1, -(-terms.count() // PASS_TERMS))
    own = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(n_passes))
    kind = terms.schema["item_id"].dataType
    results = []
    for k in range(n_passes):
        rows = (terms.where(own == k) if n_passes > 1 else terms).collect()  # about PASS_TERMS of them
        places: dict[str, int] = {}
        by_item: dict[object, list[tuple[int, int]]] = {}
        for item, term, q in rows:
            by_item.setdefault(item, []).append((places.setdefault(term, len(places)), q))
        if not rows:
            continue
        coded = {term.encode(): place for term, place in places.items()}
        held = stage_once(postings(documents, coded), "ranked-postings")
        # One row per term of these queries.
        dfs = dict(held.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
        n_documents, n_words = held.where("n > 0").agg(F.count("n"), F.sum("n")).first()
        if not n_documents:
            continue
        weight = np.array([term_weight(n_documents, dfs.get(i, 0)) for i in range(len(places))], np.int64)
        queries = []
        for listed in by_item.values():
            ids, q = np.array(sorted(listed), np.int64).T
            queries.append(Query(ids, weight[ids] * q))
        found = _search(held, queries, len(places), n_documents, n_words, top)
        named = spark.createDataFrame(list(enumerate(by_item)), f"item_no long, item_id {kind.simpleString()}")
        results.append(_merged(found, top).join(F.broadcast(named), "item_no"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results).select("item_id", "rank", "doc_id", "score")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks, in two steps, so that no group grows with the number of tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    near = Window.partitionBy("item_no", F.col("part") % MERGE_GROUPS).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
    whole = Window.partitionBy("item_no").orderBy(*order)
    return few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
