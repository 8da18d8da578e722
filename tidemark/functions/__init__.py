"""Column expressions shared by the operators."""

from tidemark.functions.hashing import (
    digest,
    drawn,
    hex_bound,
    standard_normal,
    uniform,
    values_hash,
)
from tidemark.functions.scalars import edge_grid, lenient_double, safe_divide, snapshot_stamp

__all__ = [
    "digest",
    "drawn",
    "edge_grid",
    "hex_bound",
    "lenient_double",
    "safe_divide",
    "snapshot_stamp",
    "standard_normal",
    "uniform",
    "values_hash",
]
