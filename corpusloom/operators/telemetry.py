"""Host telemetry: pressure rules, critical alerts, throttle hysteresis.

Readings are ``host, ts, cpu_percent, mem_percent, mem_available_gb,
cpu_temp_c, gpu_temp_c``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Limits:
    # Fixed values.
    cpu_percent: float = 80.0
    mem_percent: float = 70.0
    free_gb: float = 4.0
    cpu_temp: float = 85.0
    gpu_temp: float = 83.0
    critical_cpu_temp: float = 95.0
    critical_gpu_temp: float = 90.0
    recovery: float = 0.8


def _over(name: str, limit: float) -> Column:
    """Temperature above a limit; a missing or zero reading does not count."""
    return F.coalesce((F.col(name) != 0) & (F.col(name) > limit), F.lit(False))


def _rules(limits: Limits) -> list[tuple[Column, Column]]:
    def text(prefix: str, name: str, unit: str) -> Column:
        return F.concat(F.lit(prefix + " ("), F.col(name).cast("string"), F.lit(unit + ")"))

    free = F.concat(
        F.lit("Memory Low ("),
        F.round("mem_available_gb", 1).cast("decimal(20,1)").cast("string"),
        F.lit("GB)"),
    )
    return [
        (_over("cpu_temp_c", limits.cpu_temp), text("CPU Temp High", "cpu_temp_c", "°C")),
        (_over("gpu_temp_c", limits.gpu_temp), text("GPU Temp High", "gpu_temp_c", "°C")),
        (F.col("cpu_percent") > limits.cpu_percent, text("CPU High", "cpu_percent", "%")),
        (F.col("mem_percent") > limits.mem_percent, text("Memory High", "mem_percent", "%")),
        (F.col("mem_available_gb") < limits.free_gb, free),
    ]


def classify_pressure(readings: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Add ``under_pressure`` and the ``reason`` of the first rule that holds."""
    flag, reason = None, None
    for condition, message in _rules(limits):
        flag = F.when(condition, True) if flag is None else flag.when(condition, True)
        reason = F.when(condition, message) if reason is None else reason.when(condition, message)
    return readings.withColumns(
        {"under_pressure": flag.otherwise(False), "reason": reason.otherwise(F.lit(""))}
    )


def critical_alerts(readings: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Readings whose temperature is critical, with ``alert``; CPU goes first."""
    cpu = _over("cpu_temp_c", limits.critical_cpu_temp)
    gpu = _over("gpu_temp_c", limits.critical_gpu_temp)
    return readings.filter(cpu | gpu).withColumn(
        "alert",
        F.when(cpu, F.concat(F.lit("CPU temp critical: "), F.col("cpu_temp_c").cast("string"), F.lit("°C")))
        .otherwise(F.concat(F.lit("GPU temp critical: "), F.col("gpu_temp_c").cast("string"), F.lit("°C"))),
    )


def throttle_signal(limits: Limits = Limits()) -> Column:
    """1 turns throttling on, 0 off, null holds, for classified readings."""
    calm = (F.col("cpu_percent") < limits.cpu_percent * limits.recovery) & (
        F.col("mem_percent") < limits.mem_percent * limits.recovery
    )
    return F.when(F.col("under_pressure"), 1).when(calm, 0)


def throttle_state(
    readings: DataFrame,
    limits: Limits = Limits(),
    order_cols: tuple[str, ...] = ("ts",),
    blocks: int = 1024,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add ``throttled``: the hysteresis state after each reading of a host.

    The last decisive signal of a host carries on until the next one.  A host
    may hold a large share of all readings, so its history is cut into time
    blocks that run in parallel: the last signal within a block is found by a
    window over the block, the last signal before it by a window over one
    summary row per block.  Blocks are cut at quantiles of the time column.
    ``initial`` (``host, throttled``) gives states to start from.
    """
    time_col = order_cols[0]
    signals = classify_pressure(readings, limits).withColumn("signal", throttle_signal(limits))
    # blocks - 1 cut points: one small row, whatever the number of readings
    seconds = F.col(time_col).cast("timestamp").cast("double")
    share = [i / blocks for i in range(1, blocks)]
    cuts = readings.agg(
        F.array_distinct(F.percentile_approx(seconds, share, 10 * blocks)).alias("cuts")
    )
    blocked = signals.withColumn("_cuts", cuts.scalar()).withColumn(
        "block",
        # never null, so the join below adds no filter that computes it again
        F.coalesce(_cut_position(seconds, F.col("_cuts"), blocks), F.lit(0)),
    ).drop("_cuts")
    in_block = Window.partitionBy("host", "block").orderBy(*order_cols)
    so_far = blocked.withColumn("_seen", F.last("signal", ignorenulls=True).over(in_block))
    order_key = F.struct(*order_cols)
    summary = blocked.groupBy("host", "block").agg(
        F.max_by("signal", F.when(F.col("signal").isNotNull(), order_key)).alias("last_signal")
    )
    earlier = Window.partitionBy("host").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = summary.select(
        "host", "block", F.last("last_signal", ignorenulls=True).over(earlier).alias("_before")
    )
    joined = so_far.join(carried, ["host", "block"])
    start = F.lit(0)
    if initial is not None:
        joined = joined.join(
            initial.select("host", F.col("throttled").cast("int").alias("_start")), "host", "left"
        )
        start = F.coalesce("_start", F.lit(0))
    state = F.coalesce("_seen", "_before", start)
    return joined.select(
        *readings.columns, "under_pressure", "reason", (state == 1).alias("throttled")
    )


def _cut_position(value: Column, cuts: Column, blocks: int) -> Column:
    """Number of cut points at or below the value: binary search by halving steps."""
    steps = [1 << i for i in reversed(range(max(1, (blocks - 1).bit_length())))]

    def advance(position: Column, step: Column) -> Column:
        return F.when(F.get(cuts, position + step - 1) <= value, position + step).otherwise(position)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
