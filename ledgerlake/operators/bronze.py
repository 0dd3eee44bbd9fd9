"""Bronze: pass-through projection plus audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.params import RunParams
from ledgerlake.sources.schemas import columns


def bronze(df: DataFrame, table: str, params: RunParams) -> DataFrame:
    """Enumerated source columns + ``_loaded_at`` (the run's load time) and
    ``_source``.  A narrow projection: no shuffle, fused into the scan stage."""
    return df.select(*columns(table),
                     params.load_ts_col.alias("_loaded_at"),
                     F.lit(params.source_tag).alias("_source"))
