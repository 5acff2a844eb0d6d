"""Comparison of storage formats: size, write and read time, CPU, memory and energy."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tillframe.constants import FORMATS, TDP_WATTS
from tillframe.functions.numbers import unit_total
from tillframe.operators.rankings import best_by_metric, energy_estimate, ratio_to_baseline
from tillframe.plans.reports import run
from tillframe.sources.files import read_table, remove, scratch_path, table_files, write_table

METRICS = [
    "file_size_mb", "write_time_s", "read_time_s", "total_time_s", "energy_consumption_wh",
    "peak_memory_mb",
]
BYTES_PER_MB = 1024 * 1024
#: The store follows the jobs through another thread; beyond this it counts as broken, and that is reported.
STORE_SECONDS = 120.0
MEMORY = ("JVMHeapMemory", "JVMOffHeapMemory")


def _each(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _job(store, job: int):
    """The store's record of a job, or None while it has none."""
    try:
        return store.job(job)
    except Py4JJavaError as error:
        if "NoSuchElement" in str(error.java_exception):
            return None
        raise


def _attempts(spark: SparkSession, jobs: list[int]) -> list:
    """The store's records of all attempts of the jobs' stages, once they have ended there."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    every = (False, gateway.jvm.java.util.ArrayList(), False, gateway.new_array(gateway.jvm.double, 0))
    deadline = time.perf_counter() + STORE_SECONDS
    while True:
        known = [_job(store, job) for job in jobs]
        if all(job is not None and job.status().toString() not in ("RUNNING", "UNKNOWN") for job in known):
            stages = {stage for job in known for stage in _each(job.stageIds())}
            found = [attempt for stage in stages for attempt in _each(store.stageData(stage, *every))]
            if all(attempt.status().toString() not in ("ACTIVE", "PENDING") for attempt in found):
                return found
        if time.perf_counter() > deadline:
            raise TimeoutError(f"Spark's status store lacks the end of some of the jobs {jobs}")
        time.sleep(0.05)


def _peak(metrics) -> int:
    """Heap and off-heap bytes of an optional record of executor peaks; 0 if there is none."""
    return sum(max(0, metrics.get().getMetricValue(name)) for name in MEMORY) if metrics.isDefined() else 0


def _pools(spark: SparkSession):
    return spark._jvm.java.lang.management.ManagementFactory.getMemoryPoolMXBeans()


def _usage(spark: SparkSession, jobs: list[int]) -> tuple[float, float | None]:
    """CPU seconds of all the jobs together, and the peak JVM memory in MB, from Spark's status store.

    In a local session memory is the sum of the peaks of the JVM's pools since they were last reset. On a cluster
    it is the largest executor's in the jobs' stages or, where these were too short for a
    heartbeat, the largest executor's so far; null before the first heartbeat.
    """
    stages = _attempts(spark, jobs)
    cpu = sum(stage.executorCpuTime() for stage in stages) / 1e9
    if spark.sparkContext.master.startswith("local"):
        peak = sum(pool.getPeakUsage().getUsed() for pool in _pools(spark))
    else:
        peak = max((_peak(stage.peakExecutorMetrics()) for stage in stages), default=0) or max(
            (_peak(executor.peakMemoryMetrics())
             for executor in _each(spark.sparkContext._jsc.sc().statusStore().executorList(False)) if executor.id() != "driver"), default=0)
    return cpu, peak / BYTES_PER_MB if peak > 0 else None


def _measured(spark: SparkSession, work) -> tuple[float, float | None, float | None]:
    """Seconds, CPU seconds and peak memory of the jobs that `work` runs."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, group)
    for pool in _pools(spark):
        pool.resetPeakUsage()
    try:
        start = time.perf_counter()
        work()
        seconds = time.perf_counter() - start
        jobs = sorted(context.statusTracker().getJobIdsForGroup(group))
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)
    return (seconds, *_usage(spark, jobs))


def measure_formats(df: DataFrame, formats: Iterable[str] = FORMATS, sums: Iterable[str] = ()) -> DataFrame:
    """One row per format; a format that fails gives a row with its error.

    The rows are stored once, and every format is written from that table and read back,
    after one round of the first format that is not measured. `scan_time_s` is a plain pass over
    the stored table, which every write contains. Reading counts the rows and adds up the columns `sums`
    exactly. CPU seconds and peak memory come from Spark's status store. All files are removed afterwards.
    """
    spark, sums = df.sparkSession, list(sums)
    totals = [unit_total(df, name).cast("double").alias(f"sum_{name}") for name in sums]
    source = scratch_path(spark, "formats-source")
    write_table(df, source)
    stored = read_table(spark, source, schema=df.schema)
    run(stored)
    scan = run(stored)
    rows, cold = [], True
    for fmt in formats:
        path = scratch_path(spark, f"format-{fmt}")
        try:
            seen = Observation()
            back = lambda: read_table(spark, path, fmt, df.schema, written_here=True)
            if cold:  # what the JVM compiles and loads on a first write and read should not count for one format
                write_table(stored, path, fmt)
                run(back())
                cold = False
            write = _measured(spark, lambda: write_table(stored, path, fmt))
            read = _measured(spark, lambda: run(back().observe(seen, F.count(F.lit(1)).alias("rows"), *totals)))
            size = table_files(spark, path).agg(F.sum("length")).first()[0]
            found = seen.get
            cpu = [used[1] for used in (write, read)]
            peaks = [used[2] for used in (write, read) if used[2] is not None]
            rows.append((
                fmt.upper(), size / BYTES_PER_MB, write[0], read[0], write[0] + read[0], scan, None, *cpu,
                sum(cpu) if None not in cpu else None, write[2], read[2], max(peaks, default=None),
                found["rows"], *[found[f"sum_{name}"] for name in sums]))
        except Exception as error:  # a failing format must not end the comparison
            rows.append((fmt.upper(), *[None] * 4, scan, f"{type(error).__name__}: {str(error).splitlines()[0]}", *[None] * (7 + len(sums))))
        finally:
            remove(spark, path)
    remove(spark, source)
    return spark.createDataFrame(
        rows,
        "format string, file_size_mb double, write_time_s double, read_time_s double, total_time_s double, scan_time_s double, "
        "error string, write_cpu_time_s double, read_cpu_time_s double, total_cpu_time_s double, "
        "write_memory_mb double, read_memory_mb double, peak_memory_mb double, row_count bigint"
        + "".join(f", sum_{name} double" for name in sums),
    )


def storage_format_report(df: DataFrame, formats: Iterable[str] = FORMATS,
                          tdp_watts: float = TDP_WATTS, sums: Iterable[str] = ()) -> DataFrame:
    """Measures per format, with size, time and energy as percentages of CSV."""
    measured = energy_estimate(measure_formats(df, formats, sums), "total_cpu_time_s", tdp_watts)
    return ratio_to_baseline(
        measured, "format", "CSV",
        {"file_size_mb": "size_pct", "total_time_s": "time_pct", "energy_consumption_wh": "energy_pct"},
    )


def best_formats(report: DataFrame) -> DataFrame:
    """The format with the smallest value of each metric."""
    return best_by_metric(report, "format", METRICS, error="error")
