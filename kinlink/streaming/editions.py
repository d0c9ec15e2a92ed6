"""Editions that arrive as a stream, kept as the newest value of each field per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinlink.sources.sinks import append_edition


def append_editions(stream: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Each micro-batch adds the editions the table lacks; a batch run again adds nothing."""
    return on_batches(stream, lambda batch: append_edition(batch, path, keys), checkpoint)


def on_batches(stream: DataFrame, work: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """All that is there now goes through work in batches, then the query ends."""
    return stream.writeStream.foreachBatch(lambda batch, _: work(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
