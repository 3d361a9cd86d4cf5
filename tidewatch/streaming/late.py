"""Rows that came behind the watermark: Spark leaves them out of every stateful operator, and tells how many they were."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidewatch.sources.credit import hadoop_files


class LateRows(StreamingQueryListener):
    """Counts the rows that each stateful operator of each query left out, batch by batch; with `folder`, writes what was left out there.

    `spark.streams.addListener(LateRows())` before the queries start. A late row is counted by the first stateful operator it reaches.
    """

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder
        self.counts: dict[str, dict[int, int]] = defaultdict(dict)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        if late:
            name, batch = progress.name or str(progress.id), int(progress.batchId)
            self.counts[name][batch] = late
            if self.spark is not None and self.folder:
                fs, place = hadoop_files(self.spark, self.folder)
                fs.mkdirs(place(self.folder))
                out = fs.create(place(f"{self.folder}/{name}-{batch}.json"), True)
                out.write(bytearray(json.dumps({"query": name, "batch": batch, "late": late, "watermark": progress.eventTime.get("watermark")}).encode()))
                out.close()

    def total(self, name: str) -> int:
        return sum(self.counts[name].values())
