"""Ingest metrics: per-batch counts via ``observe`` and a progress listener.

``observe`` computes named aggregates inside the running query (no extra
job); the listener sees them, with rows per second, in every progress event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observe_ingest(df: DataFrame, name: str = "ingest") -> DataFrame:
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("side") == F.lit("BUY")).alias("buys"),
                      F.max("volume_usd").alias("max_volume_usd"))


class ProgressLog(StreamingQueryListener):
    """Keeps (batch id, input rows, rows/s, observed metrics) per progress."""

    def __init__(self):
        self.events: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.events.append({
            "batch_id": p.batchId, "rows": p.numInputRows,
            "rows_per_sec": p.processedRowsPerSecond,
            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()},
        })

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
