"""Change streams into lake tables: each micro-batch is one merge commit."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from branchlake.operators.merge import dedupe_delta
from branchlake.sources.lake import Lake


def merge_stream(changes: DataFrame, lake: Lake, table: str, keys: list[str], order: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Upsert a stream of changed rows (with ``branch_id``). Of several changes of a key in a batch the last by ``order`` counts.

    The commit's run id holds the stream's own id, which Spark keeps in the checkpoint, and the batch's number. So a batch that is replayed after a failure is skipped, also after
    its snapshot has expired, and a batch of another stream or of a new checkpoint is not.
    """

    def one(batch: DataFrame, number: int) -> None:
        stream = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        run = f"stream-{stream}-{number}"
        if batch.isEmpty() or lake.seen(table, run):
            return
        lake.merge(table, dedupe_delta(batch, keys, [F.desc(order)]), keys, run, datetime.now())

    return changes.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
