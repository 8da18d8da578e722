"""What a table's columns are for: roles, features, label and row key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCALED = "_scaled"
INDEXED = "_indexed"
ENCODED = "_encoded"


@dataclass(frozen=True)
class FeatureSpec:
    """Declares how a raw table becomes features.

    ``numeric`` and ``categorical`` default to the type rule of
    :func:`column_roles`. ``key`` names the columns that identify a row; they
    are never features, and splitting and balancing hash them.
    """

    label: str
    key: Sequence[str] = ()
    drop: Sequence[str] = ()
    to_double: Sequence[str] = ()
    numeric: Sequence[str] | None = None
    categorical: Sequence[str] | None = None

    def roles(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """The (numeric, categorical) feature columns of ``df``, without the label."""
        typed = column_roles(df, exclude=[*self.drop, *self.key, self.label])
        numeric = list(self.numeric) if self.numeric is not None else typed[0]
        categorical = list(self.categorical) if self.categorical is not None else typed[1]
        return (
            numeric,
            [c for c in categorical if c not in numeric and c != self.label],
        )


def column_roles(
    df: DataFrame, exclude: Sequence[str] = (), narrow: bool = False
) -> tuple[list[str], list[str]]:
    """Split columns by type: numbers of any width are numeric, all others categorical.

    With ``narrow`` only int and double are, so that identifiers kept as bigint, but
    also numbers that have outgrown an int, are categories.

    Columns already scaled (``*_scaled``) are numeric results, not categories,
    and are left out of both lists.
    """
    numeric: list[str] = []
    categorical: list[str] = []
    numbers = (T.IntegerType, T.DoubleType) if narrow else T.NumericType
    for field in df.schema.fields:
        if field.name in exclude or field.name.endswith(SCALED):
            continue
        is_number = isinstance(field.dataType, numbers)
        (numeric if is_number else categorical).append(field.name)
    return numeric, categorical


def schema_differences(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str]]:
    """``(column, problem)`` for every column that is absent, extra or retyped."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    problems = []
    for name, data_type in want.items():
        if name not in have:
            problems.append((name, "missing_in_new"))
        elif have[name] != data_type:
            problems.append((name, "type_changed"))
    problems += [(name, "missing_in_base") for name in have if name not in want]
    return problems


def require_schema(expected: T.StructType, df: DataFrame) -> None:
    """Raise unless ``df`` has every expected column with its expected type."""
    broken = [p for p in schema_differences(expected, df.schema) if p[1] != "missing_in_base"]
    if broken:
        listing = ", ".join(f"{name}: {problem}" for name, problem in broken)
        raise ValueError(f"input does not meet the model's schema: {listing}")
