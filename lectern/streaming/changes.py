"""Apply a stream of row changes to a warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.upsert import latest_per_key
from lectern.sources.snapshots import SnapshotTable

DELETE = "delete"


def apply_changes(table: SnapshotTable, batch: DataFrame, version: list[str]) -> None:
    """Merge the newest change per key, as told by the version columns.

    A change older than the row held is passed over, so replaying a micro-batch or
    receiving files out of order gives the same table.  Deletions are kept as rows marked
    in the operation column: dropping them would let an older change bring a row back.
    """
    key = list(table.spec.key)
    newest = latest_per_key(batch, key, version)
    held = table.read_near(batch).select(*key, F.struct(*version).alias("_held"))
    due = (
        newest.join(held, key, "left")
        .where(F.col("_held").isNull() | (F.struct(*version) >= F.col("_held")))
        .drop("_held")
    )
    table.upsert(due, known_unique=True)


def live_rows(table: SnapshotTable, operation: str) -> DataFrame:
    """Rows whose latest change is not a deletion."""
    return table.read().where(~F.col(operation).eqNullSafe(DELETE)).drop(operation)


def start_upserts(
    changes: DataFrame, table: SnapshotTable, checkpoint: str, version: list[str], **trigger
) -> StreamingQuery:
    """Run ``apply_changes`` on every micro-batch; by default on all data available now."""

    def step(batch: DataFrame, _batch_id: int) -> None:
        batch.persist()
        try:
            apply_changes(table, batch, version)
        finally:
            batch.unpersist()

    return (
        changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
