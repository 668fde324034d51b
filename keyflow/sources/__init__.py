"""Sources: batch tables, JDBC, generators, nested payloads, streams."""

from keyflow.sources.api import flatten_results, parse_payloads, read_payloads
from keyflow.sources.generator import (
    fact_series,
    gender_dimension,
    generate_user_batch,
    generate_users,
)
from keyflow.sources.stream import file_stream, kafka_source_options, kafka_stream
from keyflow.sources.tables import (
    jdbc_options,
    jdbc_write_options,
    read_jdbc,
    read_table,
    table_path,
    write_jdbc,
)

__all__ = [
    "fact_series", "file_stream", "flatten_results", "gender_dimension",
    "generate_user_batch", "generate_users", "jdbc_options", "kafka_source_options",
    "jdbc_write_options", "kafka_stream", "parse_payloads", "read_jdbc", "read_payloads",
    "read_table", "table_path", "write_jdbc",
]
