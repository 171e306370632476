"""Exports that arrive as files, synced one micro-batch after another: an extra beside the batch flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from saldus.context import Context
from saldus.operators.normalize import normalize
from saldus.plans.flows import sync
from saldus.sources.exports import in_file_order, numbered
from saldus.sources.repository import Repository


def sync_stream(raw: DataFrame, repository: Repository, context: Callable[[int], Context], checkpoint: str) -> StreamingQuery:
    """Each micro-batch of raw export rows is a snapshot: normalised, diffed with the repository and saved. context: of a batch's number.

    Rows of a batch of several files are in the order of the files' paths and of their place in a file, so the last row of a code is that of the last file that has it; rows of a source that has no
    files, and none of an _ord of their own, are in the order in which partitions hold them. A batch that is run again after a failure meets records that it has saved already and changes nothing.
    """
    files = "_ord" not in raw.columns
    if files:
        try:
            raw = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
        except AnalysisException:  # not a source of files
            files = False

    def one(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            rows = in_file_order(batch.withColumn("_row", F.monotonically_increasing_id())) if files else numbered(batch)
            sync(repository, normalize(rows, context(number)), context(number))

    return raw.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one).start()
