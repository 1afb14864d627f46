"""Reading with a declared schema, appending, versions, and where checkpoints go."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from venueops.operators.reports import pnl_by_day
from venueops.plans.session import SETTINGS, checkpointed, tuned
from venueops.sources.schema import RESTAURANT, Table
from venueops.sources.tables import (
    append_rows,
    literal_rows,
    scan_by_period,
    stored_scan,
    typed_scan,
    update_by_period,
    write_by_period,
    write_version,
)


@pytest.fixture
def units(spark):
    return literal_rows(spark, RESTAURANT["Units"], [("кг",), ("г",)], "name")


def test_literal_rows_are_numbered_in_order(units):
    assert [tuple(r) for r in units.orderBy("id").collect()] == [(1, "кг"), (2, "г")]


def test_append_and_scan(spark, units, tmp_path):
    path = str(tmp_path / "units")
    for _ in range(4):  # numbering gives wider ids than the table declares
        append_rows(units, path, RESTAURANT["Units"])
        append_rows(units.withColumn("id", units["id"].cast("bigint") + 2), path, RESTAURANT["Units"])
    for scanned in (typed_scan(spark, path, RESTAURANT["Units"]), stored_scan(spark, path, RESTAURANT["Units"])):
        assert scanned.dtypes == [("id", "int"), ("name", "string")]
        assert sorted(r.id for r in scanned.collect()) == sorted([1, 2, 3, 4] * 4)


def test_a_version_is_never_written_over(spark, units, tmp_path):
    first = write_version(units, str(tmp_path), "v1", RESTAURANT["Units"])
    write_version(units.filter("false"), str(tmp_path), "v2", RESTAURANT["Units"])
    with pytest.raises(AnalysisException):
        write_version(units.filter("false"), str(tmp_path), "v1", RESTAURANT["Units"])
    assert spark.read.parquet(first).count() == 2


def test_scan_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "units")
    spark.range(10).selectExpr("id", "cast(id AS string) AS name", "id AS more").write.parquet(path)
    plan = typed_scan(spark, path, RESTAURANT["Units"]).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_checkpoints_are_tables_in_the_checkpoint_folder(spark, units):
    again = checkpointed(units)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).parent
    assert again.schema.simpleString() == units.schema.simpleString()
    assert all(str(folder) in name for name in again.inputFiles())
    assert sorted(again.collect()) == sorted(units.collect())


def test_settings_are_applied(spark):
    tuned(spark)
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS


SOLD = Table("sold", "id bigint!; transaction_type_id int; amount decimal(18,2); transaction_date timestamp_ntz")


@pytest.fixture(params=["day", "month", "year"])
def sold(spark, tmp_path, request):
    """Three years of sales, two without a time, one id twice."""
    rows = spark.sql(
        "SELECT id, 1 + int(id % 2) AS transaction_type_id, id AS amount, 'more' AS _hit,"
        " CASE WHEN id % 50 <> 7 THEN timestamp_ntz'2024-01-30 23:00:00' + make_dt_interval(int(id * 11), 5) END"
        " AS transaction_date FROM range(100) UNION ALL SELECT 3, 1, 5, '', timestamp_ntz'2025-05-05 00:00:00'"
    )
    path = str(tmp_path / "sold")
    write_by_period(rows, path, SOLD, "transaction_date", request.param)
    return path, request.param


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_an_update_by_period_leaves_other_files_alone(spark, sold):
    path, grain = sold
    before = {tuple(r) for r in stored_scan(spark, path, SOLD).collect()}
    files = _files(path)
    patch = stored_scan(spark, path, SOLD).filter("id IN (3, 4, 57)").filter("not (id = 3 and amount = 5)").selectExpr(
        "id", "transaction_date", "if(id = 4, null, 1000.25) AS amount", "'x' AS transaction_type_id"
    )
    update_by_period(patch, path, SOLD, "id", ["amount"], "transaction_date", grain)
    after = {tuple(r) for r in stored_scan(spark, path, SOLD).collect()}
    assert sorted((i, str(a)) for i, _, a, _ in after - before) == [(3, "1000.25"), (4, "None"), (57, "1000.25")]
    assert len(after) == len(before) == 101
    kept = {name: files[name] for name in set(files) & set(_files(path))}
    assert kept.items() <= _files(path).items()
    periods = {Path(name).parent for name in set(files) - set(kept)}
    assert len(periods) == {"day": 3, "month": 2, "year": 2}[grain] and any("__HIVE" in str(p) for p in periods)


def test_an_update_of_nothing_writes_nothing(spark, sold):
    path, grain = sold
    files = _files(path)
    none = stored_scan(spark, path, SOLD).filter("id < 0")
    update_by_period(none, path, SOLD, "id", ["amount"], "transaction_date", grain)
    assert _files(path) == files


def test_a_key_in_another_period_changes_nothing(spark, sold):
    path, grain = sold
    before = sorted(map(str, stored_scan(spark, path, SOLD).collect()))
    patch = spark.sql("SELECT 90L AS id, 0 AS amount, timestamp_ntz'2024-01-30 23:00:00' AS transaction_date")
    update_by_period(patch, path, SOLD, "id", ["amount"], "transaction_date", grain)
    assert sorted(map(str, stored_scan(spark, path, SOLD).collect())) == before


@pytest.mark.parametrize("start, end", [("2024-03-01", "2024-04-01"), ("2024-12-31 12:00:00", "2025-02-03 00:00:01")])
def test_a_report_reads_only_the_files_of_its_period(spark, sold, start, end):
    path, grain = sold
    kinds = spark.sql("SELECT * FROM VALUES (1, 'Доход'), (2, 'Расход') AS t(id, name)")
    stored = scan_by_period(spark, path, SOLD, "transaction_date", start, end, grain)
    whole = stored_scan(spark, path, SOLD)
    report, same = (pnl_by_day(x, kinds, start, end) for x in (stored, whole))
    assert report.collect() == same.collect() and report.count() > 1
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_period" in plan
    stored.collect()
    assert stored.count() == whole.filter(f"transaction_date >= '{start}' AND transaction_date < '{end}'").count()
