"""Sources and sinks."""

from .files import preview, read_csv, read_tables, write_csv, write_parquet
from .jdbc import jdbc_options, write_jdbc
from .streams import kafka_messages, text_messages

__all__ = [
    "jdbc_options",
    "kafka_messages",
    "preview",
    "read_csv",
    "read_tables",
    "text_messages",
    "write_csv",
    "write_jdbc",
    "write_parquet",
]
