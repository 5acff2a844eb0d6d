"""Reading, writing and measuring tables as files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tillframe.constants import FORMATS, ZONES
from tillframe.functions.text import readable_bytes
from tillframe.operators.checks import union_all

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: What every CSV file here has: a header, and quotes doubled inside quotes.
CSV = {"header": "true", "escape": '"'}
#: Written times keep their microseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Written text keeps its blanks; null is nothing and empty text is "".
CSV_WRITTEN = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": '""'}
#: On reading, nothing between commas becomes this and then null, so that "" stays empty text.
CSV_READ_BACK = {"nullValue": "\u0001", "emptyValue": ""}

#: The folder in a table that lists its data files; readers of the table skip it.
MANIFEST = "_manifest"

_local_scratch: dict[str, str] = {}


def table_path(base: str, zone: str, filename: str | None = None, fmt: str = "parquet") -> str:
    """`<base>/<zone>/<filename>`; the default name is `<zone>_data.<fmt>`."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; expected one of {', '.join(ZONES)}")
    return f"{base.rstrip('/')}/{zone}/{filename or f'{zone}_data.{fmt}'}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whichever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def check_inputs(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, str]:
    """Return the paths, or raise with the list of all that are missing."""
    missing = [path for path in paths.values() if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing input(s): {', '.join(missing)}")
    return dict(paths)


def input_audit(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """(name, path, present, row_count) of every path; a missing one has no row count."""

    def audit(name: str, path: str) -> DataFrame:
        present = path_exists(spark, path)
        if present:
            counted = read_table(spark, path, fmt).agg(F.count(F.lit(1)).alias("row_count"))
        else:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        return counted.select(
            F.lit(name).alias("name"), F.lit(path).alias("path"), F.lit(present).alias("present"),
            "row_count",
        )

    return union_all(audit(name, path) for name, path in paths.items())


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {', '.join(FORMATS)}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None, written_here: bool = False) -> DataFrame:
    """Read a table; CSV without a schema is inferred, which costs one more pass.

    `written_here` says that `write_table` made a CSV file: then empty text is told from
    null, and line breaks and backslashes in text come back.
    """
    _check(fmt)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV, **(CSV_READ_BACK if written_here else {}))
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    df = reader.load(path)
    return _each_text(df, _unescaped) if fmt == "csv" and written_here else df


def _each_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[
        change(F.col(f"`{field.name}`")).alias(field.name) if isinstance(field.dataType, StringType) else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])


def _escaped(text: Column) -> Column:
    """Line breaks as \\n and \\r, backslashes doubled: a record stays one line, so that files can be split."""
    for found, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(found), F.lit(written))
    return text


def _unescaped(text: Column) -> Column:
    parts = F.transform(F.split(text, r"\\\\"), lambda part: F.replace(
        F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def load_parquet(spark: SparkSession, path: str, cache: bool = False) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such path: {path}")
    df = read_table(spark, path)
    return df.cache() if cache else df


def load_table(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None) -> DataFrame | None:
    """Read a table of any format, or None if it does not exist."""
    return read_table(spark, path, fmt, schema) if path_exists(spark, path) else None


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """Read a CSV table, or None if it does not exist."""
    return load_table(spark, path, "csv", schema)


def _beside(path: str, mark: str) -> str:
    """A hidden sibling of the path."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{mark}" if parent or path.startswith("/") else f".{name}.{mark}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    paths = spark._jvm.org.apache.hadoop.fs.Path
    if not paths(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(paths(source), paths(target)):
        raise OSError(f"cannot rename {source} to {target}")


def recover(spark: SparkSession, path: str) -> bool:
    """Put back the table that a replacement set aside, if it broke off before the new one took its place.

    Call it only while nobody writes the path. True if there was something to put back.
    """
    aside = _beside(path, "old")
    if not path_exists(spark, aside):
        return False
    if path_exists(spark, path):
        remove(spark, aside)
        return False
    _rename(spark, aside, path)
    return True


def replace_table(spark: SparkSession, path: str, save: Callable[[str], None]) -> str:
    """Let `save` write a table to a hidden sibling, and then put it in the place of the one at `path`.

    A failed write leaves the old table as it was, and the rows may come from that table. The swap is two renames; `recover`
    mends a swap that broke off between them, and runs before each replacement. One writer at a time;
    where renaming copies, as in object stores, the swap takes as long as the copy.
    """
    recover(spark, path)
    fresh = _beside(path, f"new-{uuid.uuid4().hex}")
    try:
        save(fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    aside = _beside(path, "old")
    if path_exists(spark, path):
        _rename(spark, path, aside)
    _rename(spark, fresh, path)
    remove(spark, aside)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", manifest: bool = False) -> str:
    """Write the rows in the place of what is there; CSV and JSON keep microseconds, and CSV keeps text as `_escaped` has it.

    The old table stays readable until all rows are written. With `manifest` the table
    also holds the names and lengths of its files, which `file_faults` checks.
    """
    _check(fmt)
    options = {"csv": {**CSV, **CSV_WRITTEN, **TIMES}, "json": TIMES}.get(fmt, {})
    rows = _each_text(df, _escaped) if fmt == "csv" else df

    def save(place: str) -> None:
        rows.write.format(fmt).options(**options).save(place)
        if manifest:
            _names(table_files(df.sparkSession, place), place).write.json(f"{place}/{MANIFEST}")

    return replace_table(df.sparkSession, path, save)


def _names(files: DataFrame, path: str) -> DataFrame:
    """(file, length) with the names below the table's own folder."""
    folder = path.rstrip("/").rpartition("/")[2]
    return files.select(F.element_at(F.split("path", f"/\\Q{folder}\\E/"), -1).alias("file"), "length")


def file_faults(spark: SparkSession, path: str) -> DataFrame:
    """(file, written, found): files of the table whose lengths are not those of its manifest; null where there is no such file."""
    written = spark.read.schema("file string, length bigint").json(f"{path}/{MANIFEST}").withColumnRenamed("length", "written")
    found = _names(table_files(spark, path), path).withColumnRenamed("length", "found")
    return written.join(found, "file", "full").filter(~F.col("written").eqNullSafe(F.col("found")))


def save_tables(tables: Mapping[str, DataFrame], base: str, zone: str = "processed",
                fmt: str = "parquet") -> dict[str, str]:
    """Overwrite each named table under the zone's folder; returns name to path."""
    return {
        name: write_table(df, table_path(base, zone, f"{name}.{fmt}"), fmt)
        for name, df in tables.items()
    }


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that `spark.checkpoint.dir` names.

    A machine-local folder is used only where that setting is absent and the
    session itself is local; it is the same one throughout the session.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tillframe-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/tillframe/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a path on whichever file system its scheme names; False if there was none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def round_trip(df: DataFrame, fmt: str) -> DataFrame:
    """Write the rows, and read them back in the given format with the schema that is known."""
    spark = df.sparkSession
    path = write_table(df, scratch_path(spark, f"round-trip-{fmt}"), fmt)
    return read_table(spark, path, fmt, df.schema, written_here=True)


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a written table, as (path, length, modificationTime); contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def file_size_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(name, path, files, size_bytes, size, last_modified) of each written table, and of all as TOTAL."""
    files = union_all(
        table_files(spark, path).select(
            F.lit(name).alias("name"), F.lit(path).alias("path"), "length", "modificationTime"
        )
        for name, path in paths.items()
    )
    sums = files.rollup("name").agg(
        F.grouping("name").alias("is_total"),
        F.max("path").alias("path"),
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("size_bytes"),
        F.max("modificationTime").alias("last_modified"),
    )
    is_total = F.col("is_total") == 1
    return sums.select(
        F.when(is_total, F.lit("TOTAL")).otherwise(F.col("name")).alias("name"),
        F.when(~is_total, F.col("path")).alias("path"),
        "files",
        "size_bytes",
        readable_bytes(F.col("size_bytes")).alias("size"),
        "last_modified",
    )
