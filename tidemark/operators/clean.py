"""Row and column clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lenient_double
from tidemark.session import stage
from tidemark.spec import INDEXED, SCALED, FeatureSpec

REPEATED_DIGESTS = 500_000  # sent to every task, 16 bytes each


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*columns)


def cast_to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to double; text that is no number becomes NULL."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: lenient_double(c) for c in present}) if present else df


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (or any of the given) columns."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def drop_duplicates(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """Keep one of each set of equal rows; nulls are equal to each other.

    Grouping on all columns combines copies before the shuffle, so a row that
    makes up a third of the table leaves each task once. ``by_digest``, for wide rows of which few
    are copies, reads the table twice instead: 128-bit digests are counted first, and only rows
    whose digest occurs again are shuffled, and compared, whole. Where more than
    ``REPEATED_DIGESTS`` do, all rows are. The digests are staged.
    """
    if not by_digest:
        return df.distinct()
    columns = [F.col(f"`{c}`") for c in df.columns]
    one, two = F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)
    repeated = stage(
        df.select(one.alias("__one"), two.alias("__two"))
        .groupBy("__one", "__two")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("__one", "__two"),
        "repeated-digests",
    )
    if repeated.limit(REPEATED_DIGESTS + 1).count() > REPEATED_DIGESTS:
        return df.distinct()
    marked = df.withColumns({"__one": one, "__two": two})
    keys = ["__one", "__two"]
    single = marked.join(F.broadcast(repeated), keys, "left_anti").drop(*keys)
    copied = marked.join(F.broadcast(repeated), keys, "left_semi").drop(*keys)
    return single.unionAll(copied.distinct())


class Losses:
    """What :func:`clean` loses, counted in the pass that writes its result.

    ``table`` waits for that pass: call it after an action on the cleaned table.
    """

    def __init__(self) -> None:
        self.before, self.after = Observation(), Observation()

    def table(self, spark: SparkSession) -> DataFrame:
        """``(step, column, n)``: unparsable values per column, null rows, duplicates, rows read and kept."""
        before, after = self.before.get, self.after.get
        rows = [("unparsable", name.partition(":")[2], n) for name, n in before.items() if ":" in name]
        kept = after["kept"]
        rows += [
            ("read", None, before["read"]),
            ("incomplete", None, before["read"] - before["complete"]),
            ("duplicate", None, before["complete"] - kept),
            ("kept", None, kept),
        ]
        return spark.createDataFrame(rows, "step string, column string, n bigint")


def clean(df: DataFrame, spec: FeatureSpec, losses: Losses | None = None) -> DataFrame:
    """Drop, repair and deduplicate.

    Incomplete rows go first: the result is the same and they are not shuffled. ``losses`` takes the
    counts of what goes, without a further pass; it serves one table.
    """
    kept = drop_columns(df, spec.drop)
    repaired = cast_to_double(kept, spec.to_double)
    if losses is None:
        return drop_duplicates(drop_incomplete(repaired))
    wanted = [c for c in spec.to_double if c in kept.columns]
    # Text that is there but no number; blank text counts, as it is a missing value that was written.
    lost = {f"__lost{i}": F.col(c).isNotNull() & lenient_double(c).isNull() for i, c in enumerate(wanted)}
    marked = cast_to_double(kept.withColumns(lost), spec.to_double) if lost else repaired
    complete = F.lit(True)
    for f in repaired.schema.fields:
        number = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        there = F.col(f"`{f.name}`").isNotNull()
        complete = complete & (there & ~F.isnan(f"`{f.name}`") if number else there)
    counts = [F.count_if(F.col(c)).alias(f"unparsable:{name}") for c, name in zip(lost, wanted)]
    observed = marked.observe(
        losses.before, F.count(F.lit(1)).alias("read"), F.count_if(complete).alias("complete"), *counts
    ).drop(*lost)
    return drop_duplicates(drop_incomplete(observed)).observe(losses.after, F.count(F.lit(1)).alias("kept"))


def select_features(
    df: DataFrame, patterns: Sequence[str] = (SCALED, INDEXED), also: Sequence[str] = ()
) -> DataFrame:
    """Columns whose name contains one of ``patterns``, plus ``also``."""
    return df.select(
        *[F.col(c) for c in df.columns if c in also or any(p in c for p in patterns)]
    )


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """``(features, label)`` as two projections of the same rows."""
    return df.drop(label), df.select(label)
