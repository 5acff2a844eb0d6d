"""CSV with every record accounted for: rows that fit the schema, and a table of those that do not.

Spark's permissive reader turns a field that does not parse into null. Here such records, and those with too
few or too many fields, go whole to a table of rejects that names the fault, and only the rest are rows. The files are
parsed once; both parts are written to the shared scratch folder and read from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillframe.sources.files import CSV, read_table, scratch_path

RECORD = "__record"
SAMPLE_ROWS = 10_000
#: What a column may be, narrowest first; text is what remains.
CANDIDATES = ("bigint", "double", "boolean", "date", "timestamp_ntz")


@dataclass(frozen=True)
class CheckedRows:
    """`rows` in `schema`, and `rejects`: record, n_bytes, fault (`fields` or `values`) and the columns that did not parse."""

    rows: DataFrame
    rejects: DataFrame
    schema: StructType


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _fits(name: str, kind: str) -> Column:
    value = F.col(f"`{name}`")
    parsed = value.try_cast(kind).isNotNull() & (value == F.btrim(value))
    return parsed & F.lower(value).isin("true", "false") if kind == "boolean" else parsed


def narrowest(texts: DataFrame) -> StructType:
    """The narrowest type of each text column that all its values fit; text for a column without values."""
    names = texts.columns
    counts = texts.agg(*[F.count(f"`{name}`").alias(f"{i}") for i, name in enumerate(names)], *[
        F.count_if(_fits(name, kind)).alias(f"{i}:{kind}") for i, name in enumerate(names) for kind in CANDIDATES]).first()
    kinds = [next((kind for kind in CANDIDATES if counts[f"{i}"] and counts[f"{i}:{kind}"] == counts[f"{i}"]), "string")
             for i in range(len(names))]
    return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds))) if names else StructType([])


def _parsed(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> CheckedRows:
    names = schema.names
    read = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).schema(
        StructType([*[StructField(field.name, field.dataType) for field in schema], StructField(RECORD, StringType())])).csv(path)
    values = [F.col(f"`{name}`") for name in names]
    split = read.select(F.struct(*values).alias("row"), F.col(RECORD).alias("record"), F.col(RECORD).isNotNull().alias("rejected"))
    folder = scratch_path(spark, "checked-csv")
    split.write.partitionBy("rejected").parquet(folder)
    back = spark.read.schema(split.schema).parquet(folder)
    texts = F.from_csv("record", _with_record(names), {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD})
    rejects = back.filter("rejected").select("record", "row", texts.alias("texts"))
    wrong = F.array_compact(F.array(*[
        F.when(F.col(f"texts.`{name}`").isNotNull() & F.col(f"row.`{name}`").isNull(), F.lit(name)) for name in names]))
    uneven = F.col(f"texts.{RECORD}").isNotNull()
    rejects = rejects.select(
        "record", F.octet_length("record").cast("bigint").alias("n_bytes"), F.when(uneven, "fields").otherwise("values").alias("fault"),
        F.when(uneven, F.array().cast("array<string>")).otherwise(wrong).alias("columns"))
    return CheckedRows(back.filter("not rejected").select("row.*"), rejects, schema)


def _with_record(names: list[str]) -> str:
    return ", ".join([*[f"`{name}` string" for name in names], f"{RECORD} string"])


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str | None = None, *, header: bool = True,
                     multi_line: bool = False, sample_rows: int = SAMPLE_ROWS) -> CheckedRows:
    """Read CSV files with every record either a row or a reject.

    Without a schema, types come from the first `sample_rows` records and are then checked on all: a column
    with values outside its type is widened to one that fits them too, and the files are read once more.
    Without rows all columns are text. Rejects then are records with too few or too many fields.
    """
    options = {**CSV, "header": str(header).lower(), "multiLine": str(multi_line).lower()}
    if schema is not None:
        given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return _parsed(spark, path, given, options)
    texts = spark.read.options(**options).csv(path)
    found = narrowest(texts.limit(sample_rows))
    checked = _parsed(spark, path, found, options)
    faulty = [row[0] for row in checked.rejects.select(F.explode("columns")).distinct().collect()]
    if not faulty:
        return checked
    whole = narrowest(texts.select(*[f"`{name}`" for name in faulty]))
    widened = {field.name: field.dataType for field in whole}
    return _parsed(spark, path, StructType([StructField(field.name, widened.get(field.name, field.dataType)) for field in found]), options)


def reject_report(checked: CheckedRows) -> DataFrame:
    """(fault, column, records, n_bytes): rejects by fault and column; a record with several wrong columns counts in each."""
    return checked.rejects.select("fault", "n_bytes", F.explode_outer("columns").alias("column")).groupBy("fault", "column").agg(
        F.count(F.lit(1)).alias("records"), F.sum("n_bytes").alias("n_bytes"))
