"""Merkle manifest of a dataset, its leaves placed by bitmap rank queries.

Leaves of a source stand in the order of their ids. No task ever sorts them: the ids of a source
are merged into a sparse bitmap (its non-empty 64-bit words are rows, put together by a bitwise
or), a directory of popcounts over three levels of words says how many leaves come before each
word, and the place of a leaf is that number plus the popcount below its own bit. Places key
the leaves into slot arrays of 3^7 leaves; a task reduces such an array by seven levels at once, so a
tree of any height takes few shuffles. Proof paths are handed down the same arrays.

What holds in special cases:

- a null id comes before all others of its source, a null source before all others;
- rows of equal source and id stand in the order of their leaf digests; equal rows are leaves of
  their own, next to each other;
- an empty table has no root and gives no rows; a null in any other column is told from an empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pick, stage_once

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed values: what a leaf digests
FAN = 3  # fixed value: children of a node
ARRAY_LEVELS = 7  # levels a task reduces at once
ARRAY = FAN**ARRAY_LEVELS  # leaves in a slot array
NO_ID = -(2**57) - 1  # the word of null ids, below every word of a long
DIRECTORY_BITS = 20  # words, or directory entries, under one entry of the next directory
HEAVY_SHARE = 10_000  # an id with more than this part of all rows is looked up by a broadcast
HEAVY_ROWS = 10_000  # but never one with fewer rows than this
TIE_BITS = 16  # ties are ranked within so many first bits of their digests
RUN_ARRAYS = 10_000  # slot arrays of a run of equal rows made at once
PATHS = "tree string, slot long, path string, subroot string"


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in hex, of the values: ``-`` for null, else byte count, ``:`` and the text."""
    parts = []
    for value in values:
        text = value.cast("string")
        told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(told))
    return F.sha2(F.concat(*parts), 256)


# ---------------------------------------------------------------- places


def _word(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, 6), F.lit(NO_ID))


def _bit(doc_id: str) -> Column:
    return F.expr(f"shiftleft(1L, cast(coalesce({doc_id} & 63, 0) as int))")


def bitmap_words(leaves: DataFrame) -> DataFrame:
    """The non-empty words of each tree's bitmap of ids, and how many leaves fall in each."""
    return leaves.groupBy("tree", _word(F.col("id")).alias("word")).agg(
        F.bit_or(_bit("id")).alias("bits"), F.count(F.lit(1)).alias("n")
    )


def with_directory(words: DataFrame) -> DataFrame:
    """``words`` with ``before`` (leaves of the tree in smaller words) and ``total`` (of the tree).

    Sums are taken in three levels, so a window never holds more than 2^20 entries of a tree.
    """
    up = [words]
    for level in (1, 2):
        above = F.shiftright("word", DIRECTORY_BITS).alias("word")
        up.append(up[-1].groupBy("tree", above).agg(F.sum("n").alias("n")))
    top = Window.partitionBy("tree")
    known = up[2].select(
        "tree",
        "word",
        (F.sum("n").over(top.orderBy("word")) - F.col("n")).alias("before"),
        F.sum("n").over(top).alias("total"),
    )
    for level in (1, 0):
        near = Window.partitionBy("tree", "above").orderBy("word")
        below = up[level].withColumn("above", F.shiftright("word", DIRECTORY_BITS))
        below = below.withColumn("within", F.sum("n").over(near) - F.col("n"))
        known = (
            below.join(known.withColumnRenamed("word", "above"), ["tree", "above"])
            .withColumn("before", F.col("before") + F.col("within"))
            .drop("above", "within", *(["n"] if level else []))
        )
    return known


def _rank_below(bits: str, doc_id: str) -> Column:
    """How many ids of a word are smaller than this one."""
    return F.expr(
        f"cast(bit_count({bits} & ~shiftleft(-1L, cast(coalesce({doc_id} & 63, 0) as int))) as long)"
    )


def placed(leaves: DataFrame) -> DataFrame:
    """Runs of leaves: ``tree, total, slot, run, id, leaf, suspect``.

    A run is one leaf, or equal rows standing side by side from ``slot`` on. An id that occurs
    once is settled by the rank query alone. Of ids that occur often, the (at most 10,000) heaviest
    are looked up by a broadcast and the rest by the join with their words, whose groups
    are small then.
    """
    words = stage_once(bitmap_words(leaves), "merkle-words")
    rows, ids = words.agg(F.sum("n"), F.sum(F.bit_count("bits"))).first()
    index = stage_once(with_directory(words), "merkle-index")
    rank = F.col("before") + _rank_below("bits", "id")
    found = leaves.withColumn("word", _word(F.col("id")))
    if (rows or 0) == (ids or 0):
        return found.join(index.drop("n"), ["tree", "word"]).select(
            "tree", "total", rank.alias("slot"), F.lit(1).cast("long").alias("run"),
            "id", "leaf", "suspect",
        )

    often = stage_once(
        leaves.groupBy("tree", "id").agg(F.count(F.lit(1)).alias("n_id")).where("n_id > 1"),
        "merkle-often",
    )
    extra = (
        often.withColumn("word", _word(F.col("id")))
        .groupBy("tree", "word")
        .agg(F.collect_list(F.struct("id", (F.col("n_id") - 1).alias("more"))).alias("extra"))
    )
    index = stage_once(index.drop("n").join(extra, ["tree", "word"], "left"), "merkle-index")
    more = F.expr("aggregate(filter(extra, e -> e.id < id), 0L, (s, e) -> s + e.more)")
    first = rank + F.coalesce(more, F.lit(0))
    repeated = F.coalesce(F.expr("exists(extra, e -> e.id <=> id)"), F.lit(False))
    heavy = stage_once(
        often.where(F.col("n_id") > max(HEAVY_ROWS, rows // HEAVY_SHARE))
        .withColumn("word", _word(F.col("id")))
        .join(index, ["tree", "word"])
        .select("tree", F.col("id").alias("heavy_id"), F.col("total").alias("heavy_total"), first.alias("heavy_slot")),
        "merkle-heavy",
    )
    split = found.join(
        F.broadcast(heavy.withColumnRenamed("tree", "heavy_tree")),
        (F.col("tree") == F.col("heavy_tree")) & F.col("id").eqNullSafe(F.col("heavy_id")),
        "left",
    ).drop("heavy_tree", "heavy_id")
    by_word = split.where("heavy_slot is null").join(index, ["tree", "word"])
    by_id = split.where("heavy_slot is not null").select(
        "tree", F.col("heavy_total").alias("total"), F.col("heavy_slot").alias("slot"),
        F.lit(True).alias("repeated"), "id", "leaf", "suspect",
    )
    looked_up = stage_once(
        by_word.select(
            "tree", "total", first.alias("slot"), repeated.alias("repeated"), "id", "leaf", "suspect"
        ).unionByName(by_id),
        "merkle-found",
    )
    single = looked_up.where(~F.col("repeated")).withColumn("run", F.lit(1).cast("long"))
    return single.drop("repeated").unionByName(_ties(looked_up.where("repeated")))


def _ties(rows: DataFrame) -> DataFrame:
    """Runs of leaves that share an id, one after the other in the order of their digests.

    Equal rows are counted before anything moves. Digests are even in their first bits, so that a
    window holds only a small part of a large group.
    """
    group = ["tree", "total", "slot"]
    prefix = F.conv(F.hex(F.substring("leaf", 1, TIE_BITS // 8)), 16, 10).cast("int")
    runs = (
        rows.groupBy(*group, "id", "leaf")
        .agg(F.max("suspect").alias("suspect"), F.count(F.lit(1)).alias("run"))
        .withColumn("prefix", prefix)
    )
    sizes = runs.groupBy(*group, "prefix").agg(F.sum("run").alias("n"))
    earlier = Window.partitionBy(*group).orderBy("prefix")
    sizes = sizes.select(
        *group, "prefix", (F.sum("n").over(earlier) - F.col("n")).alias("earlier")
    )
    within = Window.partitionBy(*group, "prefix").orderBy("leaf")
    return (
        runs.withColumn("within", F.sum("run").over(within) - F.col("run"))
        .join(sizes, [*group, "prefix"])
        .withColumn("slot", F.col("slot") + F.col("earlier") + F.col("within"))
        .select("tree", "total", "slot", "run", "id", "leaf", "suspect")
    )


def _in_arrays(runs: DataFrame) -> DataFrame:
    """Runs cut at the borders of slot arrays, then gathered: one row per array."""
    first, last = F.expr(f"slot div {ARRAY}"), F.expr(f"(slot + run - 1) div {ARRAY}")
    stretch = F.explode(F.sequence(F.expr(f"first div {RUN_ARRAYS}"), F.expr(f"last div {RUN_ARRAYS}")))
    block = F.explode(
        F.sequence(
            F.greatest("first", F.col("stretch") * RUN_ARRAYS),
            F.least("last", (F.col("stretch") + 1) * RUN_ARRAYS - 1),
        )
    )
    low = F.greatest("slot", F.col("block") * ARRAY)
    high = F.least(F.expr("slot + run"), (F.col("block") + 1) * ARRAY)
    pieces = (
        runs.withColumns({"first": first, "last": last})
        .withColumn("stretch", stretch)
        .withColumn("block", block)
        .withColumn("at", (low - F.col("block") * ARRAY).cast("int"))
        .withColumn("n_at", (high - low).cast("int"))
    )
    members = F.collect_list(F.struct("at", "n_at", "id", "leaf", "suspect"))
    return pieces.groupBy("tree", "total", "block").agg(members.alias("members"))


# ---------------------------------------------------------------- reduction


def node(children: str) -> str:
    return hashlib.sha256(children.encode()).hexdigest()


def levels_in_array(total: int) -> int:
    """How many levels of a tree of ``total`` leaves lie within its slot arrays."""
    levels, left = 0, total
    while left > 1 and levels < ARRAY_LEVELS:
        left = -(-left // FAN)
        levels += 1
    return levels


def reduce_array(digests: list[str], levels: int) -> list[list[str]]:
    """Every level of an array, the given one first."""
    made = [digests]
    for _ in range(levels):
        below = made[-1]
        made.append([node("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return made


def path_of(slot: int, made: list[list[str]]) -> list[tuple[str, str]]:
    """Siblings to the left and to the right of a slot, level by level."""
    path = []
    for level in made[:-1]:
        low = slot - slot % FAN
        path.append(("".join(level[low:slot]), "".join(level[slot + 1 : low + FAN])))
        slot //= FAN
    return path


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        digest = node(left + digest + right)
    return digest


def written_path(path: list[tuple[str, str]]) -> str:
    return "".join(f"{left}.{right}," for left, right in path)


def read_path(text: str) -> list[tuple[str, str]]:
    return [tuple(level.split(".")) for level in text.split(",")[:-1]]


def _in_tasks(df: DataFrame, each: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Apply ``each`` to one row at a time, its results in Arrow batches of the ``schema``."""
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(each(batch.slice(i, 1).to_pylist()[0]))
                columns = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names
                )

    return df.mapInArrow(run, schema)


def _array_roots(arrays: DataFrame, column: str, filled: Callable[[dict], list[str]]) -> DataFrame:
    """The root of every slot array, as a node of the next arrays."""

    def each(row: dict) -> Iterator[tuple]:
        made = reduce_array(filled(row), levels_in_array(row["total"]))
        yield row["tree"], -(-row["total"] // ARRAY), row["block"], made[-1][0]

    needed = arrays.select("tree", "total", "block", column)
    return _in_tasks(needed, each, "tree string, total long, slot long, digest string")


def _leaves_of(row: dict) -> list[str]:
    members = row["members"]
    slots = [""] * max(m["at"] + m["n_at"] for m in members)
    for m in members:
        slots[m["at"] : m["at"] + m["n_at"]] = [m["leaf"].hex()] * m["n_at"]
    return slots


def _nodes_of(row: dict) -> list[str]:
    slots = [""] * len(row["nodes"])
    for m in row["nodes"]:
        slots[m["at"]] = m["digest"]
    return slots


def _gathered(nodes: DataFrame) -> DataFrame:
    at = F.expr(f"cast(slot % {ARRAY} as int)").alias("at")
    return nodes.groupBy("tree", "total", F.expr(f"slot div {ARRAY}").alias("block")).agg(
        F.collect_list(F.struct(at, "digest")).alias("nodes")
    )


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of all further levels, and the last node of each tree."""
    arrays, done = [], nodes.where("total = 1")
    while nodes.where("total > 1").limit(1).count():
        arrays.append(stage_once(_gathered(nodes.where("total > 1")), "merkle-arrays"))
        nodes = stage_once(_array_roots(arrays[-1], "nodes", _nodes_of), "merkle-nodes")
        done = done.unionByName(nodes.where("total = 1"))
    return arrays, done.select("tree", "digest")


def _descend(arrays: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``paths`` (and subroots) of the trees' last nodes carried down to the nodes of the first arrays."""

    def each(row: dict) -> Iterator[tuple]:
        made = reduce_array(_nodes_of(row), levels_in_array(row["total"]))
        for slot in range(len(made[0])):
            path = written_path(path_of(slot, made)) + row["path"]
            yield row["tree"], row["block"] * ARRAY + slot, path, row["subroot"]

    # A tree whose last node was reached below these arrays keeps its path as it is.
    for level in reversed(arrays):
        told = level.join(paths.withColumnRenamed("slot", "block"), ["tree", "block"])
        own = level.select("tree").distinct()
        paths = _in_tasks(told, each, PATHS).unionByName(paths.join(own, "tree", "left_anti"))
    return paths


def _in_order(trees: DataFrame) -> DataFrame:
    """``trees`` with ``slot``, their place by name, ranked within ranges of names."""
    parts = stage_once(
        trees.repartitionByRange(F.col("tree")).withColumn("part", F.spark_partition_id()),
        "merkle-trees",
    )
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier")
    within = F.row_number().over(Window.partitionBy("part").orderBy("tree")).cast("long") - 1
    return (
        parts.withColumn("within", within)
        .join(sizes.select("part", earlier), "part")
        .select("tree", "digest", (F.col("earlier") + F.col("within")).alias("slot"))
    )


# ---------------------------------------------------------------- manifest


@dataclass(frozen=True)
class Manifest:
    """Leaves in slot arrays, the path from each array to the root, and the roots."""

    arrays: DataFrame  # tree, total, block, members
    paths: DataFrame  # tree, block, path (from the array's root upwards), subroot
    subroots: DataFrame  # source, subroot
    root: str | None  # None for an empty table


def build(docs: DataFrame, suspect: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (columns ``FIELDS``; others are left out of it).

    ``suspect`` may give another text for rows to be checked against the manifest; null means
    that the row's own text is checked.
    """
    rows = pick(docs, *FIELDS)
    own = leaf_digest(*(F.col(f) for f in FIELDS))
    text = F.col("text") if suspect is None else F.coalesce(suspect, F.col("text"))
    other = leaf_digest(*(F.col(f) for f in FIELDS[:-1]), text)
    source = F.col("source").cast("string")
    leaves = stage_once(
        rows.select(
            F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("tree"),
            F.col("doc_id").cast("long").alias("id"),
            F.unhex(own).alias("leaf"),
            F.unhex(other if suspect is not None else F.lit(None).cast("string")).alias("suspect"),
        ),
        "merkle-leaves",
    )
    arrays = stage_once(_in_arrays(placed(leaves)), "merkle-arrays")
    nodes = stage_once(_array_roots(arrays, "members", _leaves_of), "merkle-nodes")
    upper, subroots = _climb(nodes)
    ordered = stage_once(_in_order(subroots), "merkle-subroots")
    n_trees = ordered.count()
    top = ordered.select(
        F.lit("").alias("tree"), F.lit(n_trees).cast("long").alias("total"), "slot", "digest"
    )
    top_arrays, roots = _climb(top)
    last = roots.first()
    start = docs.sparkSession.createDataFrame([("", 0, "", "")], PATHS)
    down = _descend(top_arrays, start).select("slot", "path")
    by_tree = ordered.join(down, "slot").select(
        "tree", F.lit(0).cast("long").alias("slot"), "path", F.col("digest").alias("subroot")
    )
    paths = stage_once(
        _descend(upper, by_tree).withColumnRenamed("slot", "block"), "merkle-paths"
    )
    name = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source")
    return Manifest(
        arrays,
        paths,
        ordered.select(name, F.col("digest").alias("subroot")),
        None if last is None else last["digest"],
    )


def audit(manifest: Manifest, with_paths: bool = False) -> DataFrame:
    """Each leaf proved and, if it has a suspect text, that one checked against the root.

    ``proof_sha256`` digests the siblings from leaf to root; ``folded_root`` is what the suspect
    (or the leaf itself) and the leaf's siblings lead to, ``verified`` whether that is the root.
    ``with_paths`` adds ``path``: per level the siblings to the left, ``.``, to the right, ``,``.
    """
    root = manifest.root or ""

    def each(row: dict) -> Iterator[tuple]:
        digests = _leaves_of(row)
        made = reduce_array(digests, levels_in_array(row["total"]))
        upper_text = row["path"]
        upper = read_path(upper_text)
        siblings = "".join(left + right for left, right in upper)
        array_root = made[-1][0]
        from_array = fold(array_root, upper)
        for m in row["members"]:
            other = m["suspect"]
            for slot in range(m["at"], m["at"] + m["n_at"]):
                path = path_of(slot, made)
                proof = "".join(left + right for left, right in path) + siblings
                reached = fold(digests[slot] if other is None else other.hex(), path)
                folded = from_array if reached == array_root else fold(reached, upper)
                found = (m["id"], digests[slot], row["subroot"], root, node(proof), folded, folded == root)
                yield (*found, written_path(path) + upper_text) if with_paths else found

    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )
    rows = manifest.arrays.join(manifest.paths, ["tree", "block"])
    return _in_tasks(rows, each, schema + (", path string" if with_paths else ""))


def audit_damaged(docs: DataFrame) -> DataFrame:
    """:func:`audit` of ``docs`` where every second id's text (by its CRC-32) has lost its line ends.

    Without an id a row is left as it is.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return audit(build(docs, F.when(chosen, F.translate("text", "\n", ""))))
