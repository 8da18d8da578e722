"""Packing token sequences by minimum bin slack.

Documents are tokenised and cut into pieces of at most the capacity; the last piece of each is
what must be combined. Only the number of pieces of each length goes to the driver, one
row per length. There a subset-sum program over a bitset finds, for the longest
piece left, the multiset of other lengths that fills its window closest to capacity, and
takes that pattern as often as the counts allow. The resulting table of patterns has a
size that depends on the capacity, not on the data. Each piece then looks up its
place by its length and its rank among pieces of that length.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from tokenizers import Tokenizer

from tidemark.llm.common import in_slices, pick, stage_once, text_slices, with_slots

CAPACITY = 2048
END_ID = 1  # fixed value: closes each document
MAX_SLACK = 8  # padding left in a window before a piece is cut to fill it
CACHED_WORDS = 150_000  # new words after which a task forgets those it has not met again
SLICE_DOCS = 200  # documents tokenised at a time


def default_vocabulary() -> str:
    """The public word vocabulary installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- tokens

# How the vocabulary's tokenizer cuts words, once texts are in lower case.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters (up to U+024F, without controls) that lower-casing is all the normalisation of.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u024f]*")


def _of_kind(kind: str) -> str:
    """The plain characters of a Unicode category, in lower case, for use in a set of characters."""
    plain = "".join(map(chr, range(0x20, 0x250)))
    found = sorted(c for c in {*plain, *plain.lower()} if unicodedata.category(c).startswith(kind))
    return "".join(map(re.escape, found))


def _parts(letters: str, numbers: str) -> re.Pattern:
    """The same cuts; what is most frequent is tried first, which changes none of them."""
    words = f"[{letters}]+|[{numbers}]"
    others = _CUT.partition("|[")[0]
    return re.compile(rf"{words}|{others}|[^\s{letters}{numbers}]+")


_PARTS = _parts(_of_kind("L"), _of_kind("N"))
_ASCII_PARTS = _parts("a-z", "0-9")  # of texts in lower case


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte: itself if it is visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in visible)
    return {b: 0x100 + k for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Known(dict):
    """Ids of parts, made when first asked for; ``before`` is what was known earlier."""

    def __init__(self, make: Callable[[str], bytes], before: dict[str, bytes] | None = None) -> None:
        self.make, self.before = make, before or {}

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part) or self.make(part)
        self[part] = ids
        return ids

    def renewed(self) -> _Known:
        """Itself or, once it is full, an empty one that remembers what this one has."""
        if len(self) <= CACHED_WORDS:
            return self
        self.before = {}
        return _Known(self.make, self)


class WordIds:
    """Token ids of a text, as the tokenizer gives them, remembering those of its parts.

    A text is cut into parts (words, digits, runs of marks), none of whose tokens reaches into another,
    so its ids are those of its parts in order. Texts beyond Latin letters, or that may hold special
    tokens, go to the tokenizer whole, as do all texts of a tokenizer that cuts otherwise. Parts not met for
    a while are forgotten: what was used since the last ``CACHED_WORDS`` new ones, and before
    that, is kept.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.kind = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.kind is np.uint16 else "I"
        told = json.loads(self.whole.to_str())
        steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.cuts = steps[0].get("pattern", {}).get("Regex") == _CUT and steps[-1].get("type") == "ByteLevel"
        self.known = _Known(self._part)

    def _encode(self, text: str) -> bytes:
        (got,) = self.whole.encode_batch_fast([text], add_special_tokens=False)
        return np.array(got.ids, dtype=self.kind).tobytes()

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS)
        ids = [token.id for token in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        out = []
        for text in texts:
            if not self.cuts or "<|" in text or not _PLAIN.fullmatch(text):
                out.append(self._encode(text))
                continue
            parts = (_ASCII_PARTS if text.isascii() else _PARTS).findall(text.lower())
            out.append(b"".join(map(self.known.__getitem__, parts)))
        self.known = self.known.renewed()
        return out


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    ids_of = _word_ids(path)
    wide = ids_of.kind().itemsize
    end = np.array([END_ID], dtype=ids_of.kind).tobytes()
    for part in in_slices(batches, SLICE_DOCS):
        doc_ids, rows = part.column(0), []
        for i, raw in enumerate(ids_of.of([t or "" for t in part.column(1).to_pylist()])):
            raw += end
            total = len(raw) // wide
            for start in range(0, total, capacity):
                ids = raw[start * wide : (start + capacity) * wide]
                rows.append((i, start, len(ids) // wide, total, ids))
        at, starts, lengths, totals, ids = zip(*rows)
        yield pa.record_batch(
            {
                "doc_id": doc_ids.take(pa.array(at)),
                "start": pa.array(starts, type=pa.int64()),
                "length": pa.array(lengths, type=pa.int32()),
                "doc_tokens": pa.array(totals, type=pa.int64()),
                "ids": pa.array(ids, type=pa.binary()),
            }
        )


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids; a null text is empty and has the closing id alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        partial(_pieces, path=path, capacity=capacity),
        f"doc_id {kind}, start long, length int, doc_tokens long, ids binary",
    )


# ---------------------------------------------------------------- the plan


def _fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length come closest to ``room``: bitset subset sums, traced back."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    target, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            target -= length * take
            used[length] = used.get(length, 0) + take
    return used


def pack_lengths(
    counts: dict[int, int], capacity: int = CAPACITY, max_slack: int = MAX_SLACK
) -> list[tuple]:
    """Places for ``counts[length]`` pieces of each length, as runs of ranks.

    Rows: length, first and last+1 rank, part's start in the piece, part's length, first
    sequence, pieces of that length in a sequence, index of the first, offset of the first.
    Where no combination comes within ``max_slack`` of the capacity, the longest
    piece left is cut and its rest waits as a shorter one. One sequence at most is emptier.
    """
    queues: dict[int, deque] = {n: deque([(n, 0, c, 0)]) for n, c in counts.items() if c}
    left = {n: c for n, c in counts.items() if c}
    rows, sequence = [], 0

    def take(length: int, number: int) -> Iterator[tuple]:
        left[length] -= number
        if not left[length]:
            del left[length]
        queue = queues[length]
        while number:
            origin, low, n, begin = queue.popleft()
            got = min(n, number)
            if got < n:
                queue.appendleft((origin, low + got, n - got, begin))
            number -= got
            yield origin, low, got, begin

    while left:
        longest = max(left)
        used = {longest: 1}
        others = {**left, longest: left[longest] - 1}
        for length, n in _fill(others, capacity - longest).items():
            used[length] = used.get(length, 0) + n
        slack = capacity - sum(n * k for n, k in used.items())
        spare = [n for n in left if left[n] > used.get(n, 0) and n > slack]
        cut = max(spare) if slack > max_slack and spare else None
        need = dict(used)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(left[n] // k for n, k in need.items())
        offset = 0
        for length, k in sorted(used.items(), reverse=True):
            index = 0
            for origin, low, got, begin in take(length, k * times):
                rows.append((origin, low, low + got, begin, length, sequence, k, index, offset))
                index += got
            offset += k * length
        if cut:
            index = 0
            for origin, low, got, begin in list(take(cut, times)):
                rows.append((origin, low, low + got, begin, slack, sequence, 1, index, offset))
                index += got
                rest = cut - slack
                queues.setdefault(rest, deque()).append((origin, low, got, begin + slack))
                left[rest] = left.get(rest, 0) + got
        sequence += times
    return rows


# ---------------------------------------------------------------- the operator


def _widened(ids: Column, wide: int) -> Column:
    narrow = np.uint16 if wide == 2 else np.uint32

    def widen(values: pa.Array) -> pa.Array:
        every = (b for part in text_slices(values) for b in part)
        return pa.array(
            [np.frombuffer(b, dtype=narrow).astype("<u4").tobytes() for b in every], pa.binary()
        )

    return F.arrow_udf(widen, BinaryType())(ids)


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, max_slack: int = MAX_SLACK
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``, and its place.

    ``ids`` are little-endian unsigned 32-bit; ``sequence_id`` and ``offset`` say where
    the piece lies. Sequences have no gaps and at most ``capacity`` ids. Null and empty
    texts give the closing id alone; a null ``doc_id`` stays null; repeated rows are
    packed as often as given; other columns are ignored; an empty table gives no rows.
    The tokens are staged once in the shared folder and shuffled once.
    """
    pieces = tokenise(pick(docs, "doc_id", "text"), path, capacity)
    staged = stage_once(pieces.withColumn("piece", F.monotonically_increasing_id()), "tokens")
    light = staged.select("piece", "length")
    counts = {r["length"]: r["count"] for r in light.groupBy("length").count().collect()}
    plan = docs.sparkSession.createDataFrame(
        pack_lengths(counts, capacity, max_slack),
        "length int, low long, high long, begin int, part int, first long, k int, i long, at int",
    )
    ranked = with_slots(light, ["length"], ["piece"], sum(counts.values()))
    index = F.col("i") + F.col("slot") - F.col("low")
    placed = (
        ranked.join(F.broadcast(plan), "length")
        .where("slot >= low and slot < high")
        .select(
            "piece",
            "begin",
            "part",
            (F.col("first") + F.floor(index / F.col("k"))).alias("sequence_id"),
            (F.col("at") + (index % F.col("k")) * F.col("part")).cast("long").alias("offset"),
        )
    )
    wide = np.dtype(_word_ids(path).kind).itemsize
    own = F.substring("ids", F.col("begin") * wide + 1, F.col("part") * wide)
    return staged.join(placed, "piece").select(
        "doc_id",
        (F.col("start") + F.col("begin")).alias("start"),
        F.col("part").cast("long").alias("length"),
        "doc_tokens",
        _widened(own, wide).alias("ids"),
        "sequence_id",
        "offset",
    )
