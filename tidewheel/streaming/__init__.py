"""Change-data messages and streaming scores."""

from .cdc import cdc_unwrap
from .score import Scorer, batch_counts, jdbc_sink, parquet_sink, prepare_rows, read_scored

__all__ = ["Scorer", "batch_counts", "cdc_unwrap", "jdbc_sink", "parquet_sink", "prepare_rows", "read_scored"]
