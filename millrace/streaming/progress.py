"""Counters of a running ingestion, told by its streams batch by batch."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Messages that name no table of the catalogue are counted under this one.
UNKNOWN = "unknown"


class IngestProgress:
    """Messages and records by source and table, batch by batch, while streams run.

    A batch counts when it has been written, as often as it may run: its counts are the result of a query over its
    messages. Metrics observed on the way would count a partition again for every task that computes it again, as two
    executors do that need it at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._batches: dict[tuple[str, str], list[tuple[str, int, int]]] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> IngestProgress:
        return self

    def __exit__(self, *error) -> None:
        pass

    def finished(self, source: str, batch: str, tally: Sequence[tuple[str, int, int]]) -> None:
        """A batch has been written, with (table, messages, records); one that ran again takes its own place."""
        with self._lock:
            self._batches[source, batch] = list(tally)

    def _sums(self, place: int) -> Counter[tuple[str, str]]:
        sums: Counter[tuple[str, str]] = Counter()
        with self._lock:
            for (source, _), tally in self._batches.items():
                for row in tally:
                    sums[source, row[0]] += row[place]
        return sums

    @property
    def messages(self) -> Counter[tuple[str, str]]:
        return self._sums(1)

    @property
    def records(self) -> Counter[tuple[str, str]]:
        return self._sums(2)

    @property
    def batches(self) -> Counter[str]:
        with self._lock:
            return Counter(source for (source, _), tally in self._batches.items() if tally)

    def counters(self) -> DataFrame:
        """(source, table_name, messages, records) so far."""
        messages, records = self.messages, self.records
        rows = [(source, table, n, records[source, table]) for (source, table), n in sorted(messages.items())]
        return self.spark.createDataFrame(rows, "source string, table_name string, messages bigint, records bigint")
