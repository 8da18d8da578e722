import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def clashing():
    """Add columns whose names clash with inputs, outputs and inner columns."""

    def add(df):
        for name in ("TEXT", "Doc_ID", "fp", "row", "slot", "label", "component_id", "c0", "ids"):
            if name not in df.columns:
                df = df.select("*", F.lit("x").alias(name))
        return df

    return add
