"""Continuous throttle state of hosts.

A micro-batch runs the batch operator, which splits a busy host's readings over
many tasks, starting from the states the batch before it left.  Those states
are one row per host, written under the batch's number: a batch that runs again
starts from the same states and writes the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from corpusloom.operators.telemetry import Limits, throttle_state

_STATE = "host {host}, throttled boolean, seen_until timestamp"


def _states(spark: SparkSession, folder: str, batch_id: int, host_type: str) -> DataFrame:
    schema = _STATE.format(host=host_type)
    if batch_id > 0:
        try:
            return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id - 1}")
        except AnalysisException as missing:
            raise RuntimeError(f"states of batch {batch_id - 1} are gone from {folder}") from missing
    return spark.createDataFrame([], schema)


def throttle_stream(
    readings: DataFrame,
    state_folder: str,
    output_folder: str,
    checkpoint: str,
    limits: Limits = Limits(),
    blocks: int = 64,
    order_cols: tuple[str, ...] = ("ts",),
    late_folder: str | None = None,
) -> StreamingQuery:
    """Write ``throttled`` for a stream of readings; one state per host.

    Results go to ``output_folder/batch=<n>``.  Hysteresis depends on order, so a
    reading before the last one processed of its host can no longer take part; it
    is kept as it came in ``late_folder/batch=<n>`` (``<output_folder>-late`` unless
    named).  A reading at the same time as the last one follows it.  Within a
    micro-batch ``order_cols`` decide; name a unique column after the time where
    times may be equal.
    """
    late_folder = late_folder or output_folder.rstrip("/") + "-late"
    time_col = order_cols[0]
    host_type = readings.schema["host"].dataType.simpleString()

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _states(spark, state_folder, batch_id, host_type)
        placed = batch.join(before.select("host", "seen_until"), "host", "left")
        late = F.coalesce(F.col(time_col) < F.col("seen_until"), F.lit(False))
        placed.filter(late).select(*batch.columns).write.mode("overwrite").parquet(
            f"{late_folder}/batch={batch_id}"
        )
        fresh = placed.filter(~late).select(*batch.columns)
        done = throttle_state(fresh, limits, order_cols, blocks=blocks, initial=before)
        out = f"{output_folder}/batch={batch_id}"
        done.write.mode("overwrite").parquet(out)
        last = (
            spark.read.schema(done.schema).parquet(out)
            .groupBy("host")
            .agg(
                F.max_by("throttled", F.struct(*order_cols)).alias("throttled"),
                F.max(time_col).alias("seen_until"),
            )
        )
        carried = before.join(last.select("host"), "host", "left_anti").unionByName(last)
        carried.write.mode("overwrite").parquet(f"{state_folder}/batch={batch_id}")

    return (
        readings.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
