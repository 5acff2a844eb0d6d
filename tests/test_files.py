import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillframe.operators.checks import reconcile
from tillframe.plans import reports, storage
from tillframe.sources import checked, files


@pytest.fixture
def typed(spark):
    return spark.range(50).select(
        "id", (F.col("id") / 8).alias("price"), F.concat(F.lit('a "b", '), F.col("id")).alias("name"),
        F.expr("timestamp_ntz'2024-03-10 02:30:00' + make_dt_interval(0, 0, id)").alias("at"),
        F.expr("date_add(DATE'2024-01-01', cast(id as int))").alias("day"),
        (F.col("id") % 2 == 0).alias("even"),
    )


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip_keeps_every_row(typed, fmt):
    back = files.round_trip(typed, fmt)
    assert back.dtypes == typed.dtypes
    assert reconcile(typed, back).first()["same_rows"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip_keeps_odd_values(spark, fmt):
    texts = ["007", "", None, " blank ends ", "line\nbreak", "cr\r\nlf", 'a "quoted", one', "\\n", "\\", "\\\\n\n", "\\N", "null", "1e5", "é日", ",", '"', '""']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").select(
        "id", "text", F.expr("timestamp_ntz'2024-03-10 02:30:00.000001' + make_dt_interval(0, 0, id, 0.123456)").alias("at"),
        F.expr("timestamp'2024-03-10 02:30:00.999999Z' + make_dt_interval(0, id)").alias("instant"),
        F.expr("cast(id as double) / 7").alias("ratio"), F.expr("cast(id as decimal(20,6)) / 8").alias("part"),
        F.when(F.col("id") % 3 == 0, F.col("id")).cast("bigint").alias("some"), F.lit("x").alias("odd `name`.1".replace("`", "")))
    back = files.round_trip(df, fmt)
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_lines_are_records(spark, tmp_path):
    path = files.write_table(spark.createDataFrame([("a\nb",), ("c",)], "t string").coalesce(1), str(tmp_path / "x.csv"), "csv")
    assert [r[0] for r in spark.read.text(path).collect()] == ["t", "a\\nb", "c"]


def test_plain_csv_of_others(spark, tmp_path):
    (tmp_path / "y.csv").write_text('id,path,note\n1,C:\\new,\n2,"say ""x""",""\n')
    assert rows(files.load_csv(spark, str(tmp_path / "y.csv"))) == [(1, "C:\\new", None), (2, 'say "x"', None)]


def test_paths(spark, tmp_path):
    assert files.table_path("/data/", "raw") == "/data/raw/raw_data.parquet"
    assert files.table_path("/data", "processed", "x.csv") == "/data/processed/x.csv"
    assert files.table_path("/data", "processed", fmt="json") == "/data/processed/processed_data.json"
    with pytest.raises(ValueError, match="zone"):
        files.table_path("/data", "tmp")
    with pytest.raises(ValueError, match="format"):
        files.write_table(spark.range(1), str(tmp_path / "x"), "xlsx")


def test_missing_inputs(spark, tmp_path):
    there = files.write_table(spark.range(4), str(tmp_path / "there.parquet"))
    paths = {"a": there, "b": f"{tmp_path}/b.parquet", "c": f"{tmp_path}/c.parquet"}
    with pytest.raises(FileNotFoundError, match=r"b\.parquet, .*c\.parquet"):
        files.check_inputs(spark, paths)
    assert files.check_inputs(spark, {"a": there}) == {"a": there}
    assert rows(files.input_audit(spark, paths).drop("path")) == [("a", True, 4), ("b", False, None), ("c", False, None)]
    with pytest.raises(FileNotFoundError):
        files.load_parquet(spark, paths["b"])
    assert files.load_csv(spark, f"{tmp_path}/none.csv") is None
    cached = files.load_parquet(spark, there, cache=True)
    assert cached.storageLevel.useMemory and cached.count() == 4
    cached.unpersist()


def test_saved_tables_and_their_sizes(spark, tmp_path):
    saved = files.save_tables({"a": spark.range(100), "b": spark.range(5)}, str(tmp_path), "raw")
    assert saved == {"a": f"{tmp_path}/raw/a.parquet", "b": f"{tmp_path}/raw/b.parquet"}
    files.save_tables({"a": spark.range(7)}, str(tmp_path), "raw")  # overwrites
    assert spark.read.parquet(saved["a"]).count() == 7
    report = {r["name"]: r for r in files.file_size_report(spark, saved).collect()}
    on_disk = {n: sum(f.stat().st_size for f in (tmp_path / "raw" / f"{n}.parquet").glob("part-*")) for n in saved}
    assert {n: report[n]["size_bytes"] for n in saved} == on_disk
    assert report["TOTAL"]["last_modified"] == max(report[n]["last_modified"] for n in saved)
    assert report["TOTAL"]["size_bytes"] == sum(on_disk.values()) and report["TOTAL"]["path"] is None


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = (files.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(base) and first != second


def test_storage_report(spark):
    df = spark.range(2000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    folder = os.path.dirname(files.write_table(spark.range(1), files.scratch_path(spark, "x"))).removeprefix("file:")
    before = set(os.listdir(folder))
    report = storage.storage_format_report(df, ["csv", "parquet", "xlsx"], sums=["id"])
    by_format = {r["format"]: r for r in report.collect()}
    assert set(by_format) == {"CSV", "PARQUET", "XLSX"}
    assert by_format["XLSX"]["error"].startswith("ValueError: unknown format 'xlsx'") and by_format["XLSX"]["size_pct"] is None
    assert [(by_format[f]["row_count"], by_format[f]["sum_id"]) for f in ("CSV", "PARQUET")] == [(2000, 1999000.0)] * 2
    csv = by_format["CSV"]
    assert csv["error"] is None and csv["size_pct"] == csv["time_pct"] == 100.0
    assert csv["total_time_s"] == pytest.approx(csv["write_time_s"] + csv["read_time_s"])
    # from Spark's status store
    assert csv["write_cpu_time_s"] > 0 and csv["read_cpu_time_s"] > 0 and csv["scan_time_s"] > 0
    assert csv["total_cpu_time_s"] == pytest.approx(csv["write_cpu_time_s"] + csv["read_cpu_time_s"])
    assert csv["total_cpu_time_s"] <= csv["total_time_s"] * 8 * 1.1
    assert csv["peak_memory_mb"] == max(csv["write_memory_mb"], csv["read_memory_mb"]) > 1
    assert csv["energy_consumption_wh"] == pytest.approx(csv["total_cpu_time_s"] * 65 / 3600)
    best = dict((r["metric"], r["best"]) for r in storage.best_formats(report).collect())
    assert set(best) == set(storage.METRICS) and best["file_size_mb"] in ("CSV", "PARQUET")
    assert {p for p in os.listdir(folder) if p.startswith("format")} <= before  # nothing is left behind


def test_usage_counts_the_jobs_tasks(spark):
    def work():
        spark.range(40_000_000).selectExpr("sum(sqrt(id) * sin(id))").collect()

    seconds, cpu, peak = storage._measured(spark, work)
    assert 0.02 < cpu <= seconds * 8 * 1.1 and peak > 1
    assert storage._measured(spark, lambda: None)[1] == 0


def test_unfinished_jobs_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(storage, "STORE_SECONDS", 0.0)
    with pytest.raises(TimeoutError, match="lacks the end"):
        storage._usage(spark, [10**6])


def test_timed_report(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(10)

    report = reports.timed_report(spark, {"a": build, "b": lambda: spark.range(5)}).collect()
    assert built == [1] and [r["operation"] for r in report] == ["a", "b"]
    assert sum(r["pct"] for r in report) == pytest.approx(100) and all(r["seconds"] > 0 for r in report)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = files.write_table(spark.range(10), str(tmp_path / "t.parquet"))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        files.write_table(broken, path)
    assert spark.read.parquet(path).count() == 10 and os.listdir(tmp_path) == ["t.parquet"]


def test_a_table_can_be_replaced_from_itself(spark, tmp_path):
    path = files.write_table(spark.range(10), str(tmp_path / "t.parquet"))
    for _ in range(2):
        files.write_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(row.id for row in spark.read.parquet(path).collect()) == list(range(2, 12))
    assert os.listdir(tmp_path) == ["t.parquet"]


def test_a_swap_that_broke_off_is_mended(spark, tmp_path):
    path = files.write_table(spark.range(10), str(tmp_path / "t.parquet"))
    os.rename(path, tmp_path / ".t.parquet.old")
    assert files.recover(spark, path) and spark.read.parquet(path).count() == 10
    assert not files.recover(spark, path)
    os.rename(path, tmp_path / ".t.parquet.old")
    files.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t.parquet"]


def test_manifest_names_lost_and_changed_files(spark, tmp_path):
    path = files.write_table(spark.range(40).repartition(4), str(tmp_path / "a+b t.parquet"), manifest=True)
    assert spark.read.parquet(path).count() == 40 and files.file_faults(spark, path).count() == 0
    parts = sorted(str(p) for p in (tmp_path / "a+b t.parquet").glob("part-*"))
    length = os.path.getsize(parts[0])
    os.remove(parts[0])
    with open(parts[1], "ab") as grown:
        grown.write(b"x")
    faults = {row.file: (row.written, row.found) for row in files.file_faults(spark, path).collect()}
    other = os.path.getsize(parts[1])
    assert faults == {os.path.basename(parts[0]): (length, None), os.path.basename(parts[1]): (other - 1, other)}


LINES = ["id,when,amount,note", "1,2024-01-05,2.5,plain", "2,2024-01-06,foo,bad amount", "3,2024-01-07", "4,2024-01-08,1,too,many",
         'x5,never,7.25,"two, faults"', "6,,,", '7,2024-01-09,3,"a ""quoted"" word"']


@pytest.fixture
def csv_path(tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "in.csv")


def test_every_csv_record_is_a_row_or_a_reject(spark, csv_path):
    found = checked.read_csv_checked(spark, csv_path, "id int, when date, amount double, note string")
    assert rows(found.rows.selectExpr("id", "cast(when as string)", "amount", "note").orderBy("id")) == [
        (1, "2024-01-05", 2.5, "plain"), (6, None, None, None), (7, "2024-01-09", 3.0, 'a "quoted" word')]
    assert {row.record: (row.n_bytes, row.fault, row.columns) for row in found.rejects.collect()} == {
        LINES[2]: (len(LINES[2]), "values", ["amount"]), LINES[3]: (len(LINES[3]), "fields", []),
        LINES[4]: (len(LINES[4]), "fields", []), LINES[5]: (len(LINES[5]), "values", ["id", "when"])}
    assert {(r.fault, r.column): (r.records, r.n_bytes) for r in checked.reject_report(found).collect()} == {
        ("values", "amount"): (1, len(LINES[2])), ("values", "id"): (1, len(LINES[5])), ("values", "when"): (1, len(LINES[5])),
        ("fields", None): (2, len(LINES[3]) + len(LINES[4]))}


def test_types_from_a_sample_are_checked_on_all_rows(spark, tmp_path):
    lines = ["a,b,c,d,e"] + [f"{i},{i},true,2024-02-0{1 + i % 9},9" for i in range(50)] + ["3000000000,x,false,2024-03-01,1.5"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    found = checked.read_csv_checked(spark, str(tmp_path / "in.csv"), sample_rows=10)
    assert [field.dataType.simpleString() for field in found.schema] == ["bigint", "string", "boolean", "date", "double"]
    assert found.rows.count() == 51 and found.rejects.count() == 0
    (tmp_path / "empty.csv").write_text("a,b\n")
    empty = checked.read_csv_checked(spark, str(tmp_path / "empty.csv"))
    assert empty.rows.dtypes == [("a", "string"), ("b", "string")] and empty.rows.count() == 0 == empty.rejects.count()
