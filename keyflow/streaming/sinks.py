"""Sinks for the streaming job besides the Parquet ``KeyedUpsertTable``.

Any object with ``write_epoch(batch, epoch)`` can be the job's sink. A
wide-column store keyed by ``id`` (the reference's target) is itself a
last-write-wins upsert, so appending a replayed batch leaves the table as it
was; the connector does the per-partition batching and consistency level.
The connector jar is not part of this environment: these options are
unit-tested as values only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"


def cassandra_session_conf(hosts: list[str], consistency: str = "QUORUM") -> dict[str, str]:
    """Session settings for the connector: contact points and read/write
    consistency (QUORUM survives one replica down at replication factor 3)."""
    return {
        "spark.cassandra.connection.host": ",".join(hosts),
        "spark.cassandra.output.consistency.level": consistency,
        "spark.cassandra.input.consistency.level": consistency,
    }


def cassandra_table_ddl(keyspace: str, table: str, columns: list[tuple[str, str]],
                        key: str, replication: dict[str, str] | None = None) -> list[str]:
    """Idempotent keyspace and table DDL (CQL) for the sink table."""
    repl = replication or {"class": "SimpleStrategy", "replication_factor": "1"}
    repl_text = ", ".join(f"'{k}': '{v}'" for k, v in repl.items())
    cols = ", ".join(f"{name} {ctype}" for name, ctype in columns)
    return [
        f"CREATE KEYSPACE IF NOT EXISTS {keyspace} WITH replication = {{{repl_text}}}",
        f"CREATE TABLE IF NOT EXISTS {keyspace}.{table} ({cols}, PRIMARY KEY ({key}))",
    ]


@dataclass
class CassandraSink:
    """Append a micro-batch to a keyed table (upsert by primary key)."""

    keyspace: str
    table: str
    options: dict[str, str] = field(default_factory=dict)

    def write_options(self) -> dict[str, str]:
        return {"keyspace": self.keyspace, "table": self.table, **self.options}

    def write_epoch(self, batch: DataFrame, epoch: int) -> None:
        batch.write.format(CASSANDRA_FORMAT).options(**self.write_options()) \
            .mode("append").save()
