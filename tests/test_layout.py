"""Bucketed layout: same results, and the case-keyed joins read co-located buckets."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from crimestats.functions.predicates import Period
from crimestats.plans import homicide as H
from crimestats.plans import index_crime as I
from crimestats.sources.fixtures import load_fixture_tables
from crimestats.sources.layout import write_bucketed_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _exchanges_on(plan: str, key: str) -> int:
    """Shuffles partitioned on exactly one column, ``key`` (a join or per-key aggregate)."""
    return len(re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)", plan))


def test_bucketed_tables_give_same_reports_without_case_shuffles(spark):
    flat = load_fixture_tables(spark, SF)
    bucketed = write_bucketed_tables(flat, "crimestats_layout_test", buckets=8)
    p = Period.calendar_year(1996)
    for method in ("single_pass", "union"):
        a = I.index_records(flat, p, method=method)
        b = I.index_records(bucketed, p, method=method)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ra, rb = H.homicide_report(flat, p, ordered=False), H.homicide_report(bucketed, p, ordered=False)
    assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_flat = I.index_records(flat, p, materialize=False)._jdf.queryExecution().executedPlan().toString()
        plan_bucketed = I.index_records(bucketed, p, materialize=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _exchanges_on(plan_flat, "CASE_ID") >= 2
    assert _exchanges_on(plan_bucketed, "CASE_ID") == 0
    assert _exchanges_on(plan_bucketed, "ID") == 0


def test_parquet_reader_round_trip(spark, tmp_path):
    from crimestats.sources.tables import read_parquet_tables

    flat = load_fixture_tables(spark, SF)
    for name in flat.names():
        getattr(flat, name).write.mode("overwrite").parquet(str(tmp_path / name))
    read = read_parquet_tables(spark, str(tmp_path))
    p = Period.calendar_year(1996)
    a, b = I.index_report(flat, p), I.index_report(read, p)
    assert a.collect() == b.collect()
    ra, rb = H.homicide_report(flat, p, ordered=False), H.homicide_report(read, p, ordered=False)
    assert sorted(map(tuple, ra.collect()), key=repr) == sorted(map(tuple, rb.collect()), key=repr)  # T26


def test_reports_scan_each_table_once_and_have_the_declared_columns(spark):
    """Staged: the cases and the period's homicides and offenders are written by one scan each; the plans read those."""
    from crimestats.schemas import INDEX_RECORD, INDEX_TOTALS, SHR_ROW

    tables = write_bucketed_tables(load_fixture_tables(spark, SF), "crimestats_scan_test", buckets=4)
    p = Period.calendar_year(1996)
    for method in ("single_pass", "union"):
        records = I.index_records(tables, p, method=method)
        plan = records._jdf.queryExecution().optimizedPlan().toString()
        assert "crimestats_scan_test.crimes" not in plan
        assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in INDEX_RECORD]
    totals = I.index_totals(I.index_records(tables, p))
    assert [(f.name, f.dataType) for f in totals.schema] == [(f.name, f.dataType) for f in INDEX_TOTALS]
    report = H.homicide_report(tables, p)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "crimestats_scan_test.homicides" not in plan and "crimestats_scan_test.offenders" not in plan
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in SHR_ROW]


def test_records_are_not_shuffled_to_be_distinct(spark):
    """No shuffle by the record's columns: the parts of the set are made distinct by their own keys.  Each table is scanned once."""
    tables = load_fixture_tables(spark, SF)
    p = Period.calendar_year(1996)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for method in ("single_pass", "union"):
            plan = _whole_plan(spark, I.index_records(tables, p, method=method))
            keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
            assert keys and not [k for k in keys if "FBI_CD" in k.replace("VFBI_CD", "") or len(k.split(",")) > 4], (method, keys)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = write_bucketed_tables(tables, "crimestats_once_test", buckets=2)
    for method, scans in (("single_pass", 1), ("union", 0)):
        plan = _whole_plan(spark, I.index_records(stored, p, method=method))
        assert plan.split("Initial Plan")[-1].count("crimestats_once_test.case_iucr") == scans, method


def _report_shuffles(spark, tables, period) -> list[str]:
    """Shuffles of the report's plan in the shape it has on large inputs; what is staged was run before."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = H.homicide_report(tables, period)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return re.findall(r"(?<![A-Za-z])Exchange \w+", plan)


def test_homicide_report_shuffles(spark, monkeypatch):
    """15 shuffles after staging at most, also when every rank has many buckets (whose shifts are broadcast)."""
    from crimestats.operators import ranking

    tables = load_fixture_tables(spark, SF)
    p = Period.calendar_year(1996)
    whole = sorted(map(tuple, H.homicide_report(tables, p).collect()), key=repr)
    assert len(_report_shuffles(spark, tables, p)) <= 15
    monkeypatch.setattr(ranking, "BUCKET_BYTES", 1000)
    assert len(_report_shuffles(spark, tables, p)) <= 15
    assert sorted(map(tuple, H.homicide_report(tables, p).collect()), key=repr) == whole


def test_a_period_reads_its_folders_only(spark, tmp_path):
    """Other folders' files are spoilt after the write: reading any of them would fail."""
    from crimestats.sources.layout import write_dated_tables

    flat = load_fixture_tables(spark, SF)
    dated = write_dated_tables(flat, str(tmp_path))
    assert dated.crimes.columns[-1] == "DATEOCC_MONTH" and dated.homicides.columns[-1] == "INJURY_DATE_MONTH"
    for name in ("crimes", "homicides"):
        assert getattr(dated, name).count() == getattr(flat, name).count()
    p = Period.calendar_year(1996)
    want = [sorted(map(tuple, x.collect()), key=repr) for x in (I.index_records(flat, p), H.homicide_report(flat, p))]
    spoilt = 0
    for name in ("crimes", "homicides"):
        for folder in (tmp_path / name).iterdir():
            if "_MONTH=" in folder.name and not folder.name.split("=")[1].startswith("1996"):
                for file in folder.glob("*.parquet"):
                    file.write_bytes(b"not parquet")
                    (folder / f".{file.name}.crc").unlink(missing_ok=True)
                    spoilt += 1
    assert spoilt
    dated = read_dated(spark, tmp_path)
    got = [sorted(map(tuple, x.collect()), key=repr) for x in (I.index_records(dated, p), H.homicide_report(dated, p))]
    assert got == want
    plan = _whole_plan(spark, I.case_base(dated, p))
    assert re.search(r"PartitionFilters: \[[^\]]*DATEOCC_MONTH#\d+ >= 199601[^\]]*<= 199612", plan)


def _whole_plan(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def read_dated(spark, root):
    from crimestats.sources.tables import read_parquet_tables

    return read_parquet_tables(spark, str(root))


def test_bucketed_tables_are_pruned_by_year(spark):
    tables = write_bucketed_tables(load_fixture_tables(spark, SF), "crimestats_years_test", buckets=2)
    plan = _whole_plan(spark, H.homicide_base(tables, Period.calendar_year(1996)))
    assert re.search(r"PartitionFilters: \[[^\]]*INJURY_DATE_YEAR#\d+ >= 1996[^\]]*<= 1996", plan)


def test_only_rows_of_the_staged_cases_are_shuffled(spark):
    """The case-keyed tables meet the filter of the period's cases below their shuffles, with their own filters still at the scan."""
    tables = write_bucketed_tables(load_fixture_tables(spark, SF), "crimestats_filter_test", buckets=2)
    p = Period.calendar_year(1996)
    cb = I.case_base(tables, p)
    cut = I.of_cases(tables, cb)
    cases = {r.ID for r in cb.collect()}
    for name in ("victims", "case_iucr", "properties"):
        whole, kept = getattr(tables, name), getattr(cut, name)
        rows, few = whole.count(), kept.count()
        of_period = whole.where(F.col("CASE_ID").isin(list(cases))).count()
        assert of_period <= few < of_period + (rows - of_period) * 0.25 + 10
    plan = _whole_plan(spark, I.index_records(tables, p))
    for name, pushed in (("victims", "In(VFBI_CD"), ("case_iucr", "In(IUCR_CODE_CD"), ("properties", "EqualTo(BURNED_I,Y)")):
        scan = next(line for line in plan.split("\n") if f"crimestats_filter_test.{name}[" in line)
        assert pushed in scan
    assert plan.count("BroadcastHashJoin [__key_word") == 3
