"""Repeatable pseudo-random columns derived from row keys.

A row's draw depends only on its key and a salt, never on the partition it
happens to sit in, so retries, repartitioning and lost executors cannot change
a split or a resampled table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD_HEX = 8  # hex digits of the digest used per draw: 32 bits
_WORD_SPAN = 4294967296.0  # 2 ** 32


def digest(keys: Sequence[str | Column], salt: str) -> Column:
    """md5 of ``salt|key1|key2...`` as 32 hex digits; nulls count as ``\\N``."""
    parts = [
        F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("\\N"))
        for k in keys
    ]
    return F.md5(F.concat_ws("|", F.lit(salt), *parts))


def _word(keys: Sequence[str | Column], salt: str, word: int) -> Column:
    return F.substring(digest(keys, salt), 1 + word * _WORD_HEX, _WORD_HEX)


def uniform(keys: Sequence[str | Column], salt: str, word: int = 0) -> Column:
    """A draw in [0, 1) per key; ``word`` (0-3) picks independent digest parts."""
    return F.conv(_word(keys, salt, word), 16, 10).cast("double") / F.lit(_WORD_SPAN)


def hex_bound(share: float) -> str:
    """The hex digits that draws below ``share`` sort before.

    A draw is k / 2**32 for a whole k, so ``draw < share`` says that k is below
    share * 2**32 rounded up, and digits of equal length sort like numbers.
    """
    bound = math.ceil(share * _WORD_SPAN)
    return "g" if bound >= _WORD_SPAN else f"{max(bound, 0):0{_WORD_HEX}x}"


def drawn(keys: Sequence[str | Column], salt: str, bound: str | Column) -> Column:
    """``uniform(keys, salt) < share`` given :func:`hex_bound` of the share.

    Compares digits as text, sparing every row the conversion to a number.
    """
    return _word(keys, salt, 0) < (F.lit(bound) if isinstance(bound, str) else bound)


def values_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash of a row's values, standing in for a key where there is none."""
    return F.xxhash64(*[F.col(c) for c in columns])


def standard_normal(keys: Sequence[str | Column], salt: str) -> Column:
    """N(0, 1) per key by Box-Muller; ``1 - u`` because a draw may be exactly 0."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(keys, salt, 0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(keys, salt, 1))
