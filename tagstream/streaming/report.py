"""Progress per batch."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tagstream.sinks.offset_log import OffsetLog, ranges_from_progress

log = logging.getLogger("tagstream")


@dataclass(frozen=True)
class BatchReport:
    """Counts of one batch. Tasks repeated after a lost executor may count twice."""

    batch_id: int
    written_at: datetime
    n_in: int
    n_good: int
    n_bad: int
    n_keys: int
    n_rejected: int = 0


OnReport = Callable[[BatchReport], None]


def log_report(report: BatchReport) -> None:
    counts = {n: v for n, v in asdict(report).items() if n.startswith("n_")}
    log.info("batch %d at %s: %s", report.batch_id, report.written_at.strftime("%Y-%m-%d %H:%M:%S"), counts)


class OffsetListener(StreamingQueryListener):
    """Keeps the offset log of a Kafka query from its progress, after each commit."""

    def __init__(self, spark: SparkSession, offsets: OffsetLog, query_name: str):
        self.spark, self.offsets, self.query_name = spark, offsets, query_name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.query_name or not progress.numInputRows:
            return
        source = progress.sources[0]
        ranges = ranges_from_progress(self.spark, source.startOffset, source.endOffset)
        self.offsets.append(ranges, progress.batchId)

    def onQueryTerminated(self, event) -> None:
        pass
