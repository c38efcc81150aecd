"""Load stamps appended to published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_audit_columns(df: DataFrame, run_id: str) -> DataFrame:
    """Add the load time and the id of the run that produced the rows."""
    return df.withColumns({"loaded_at": F.current_timestamp(), "run_id": F.lit(run_id)})
