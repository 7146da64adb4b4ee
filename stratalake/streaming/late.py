"""An account of rows that came after the watermark and were left out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from stratalake.sinks.tables import write_table

LATE = (
    "consulta string, id_consulta string, lote bigint, momento string, marca_de_agua string, operador string, "
    "filas_descartadas bigint, filas_leidas bigint"
)


class LateRows(StreamingQueryListener):
    """Appends one row for each micro-batch and stateful operator that left late rows out.

    Rows are counted as they reach the operator, which for a grouping is one for each group that a task has read. Use it
    around the queries::

        with LateRows(spark, path):
            start_hourly(spark, cfg).awaitTermination()
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path, fmt
        self.writer = ThreadPoolExecutor(1)  # a listener must not wait for jobs
        self.writes = []

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names of the listener's interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        rows = [
            (p.name, str(p.id), p.batchId, p.timestamp, p.eventTime.get("watermark"), o.operatorName, o.numRowsDroppedByWatermark, p.numInputRows)
            for o in p.stateOperators
            if o.numRowsDroppedByWatermark > 0
        ]
        if rows:
            self.writes.append(self.writer.submit(self._write, rows))

    def _write(self, rows: list[tuple]) -> None:
        write_table(self.spark.createDataFrame(rows, LATE).coalesce(1), self.path, self.fmt, mode="append")

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        """Wait until all that was reported is written."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)
        self.writer.shutdown(wait=True)
        for write in self.writes:
            write.result()
