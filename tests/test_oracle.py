"""Every registered query against its DuckDB oracle on the sf0.001 test tables,
plus invariants of the reports (SURVEY §5 layers 2-4)."""

from __future__ import annotations

import os

import pytest
from oracle_compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from crimestats.functions.predicates import Period
from crimestats.plans import homicide as H
from crimestats.plans import index_crime as I
from crimestats.sources.fixtures import load_fixture_tables

from crimestats.duckdb_checks import oracle_queries
from crimestats.registry import all_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(oracle_queries())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and df.columns[:2] == ["YEAR", "MONTH"]


def test_all_queries_match_oracle(spark):
    results = compare(spark, SF, list(all_queries()), verbose=False)
    bad = {k: r for k, r in results.items()
           if not (r.get("rows_match") and r.get("schema_match") and r.get("hash_match"))}
    assert not bad, bad


def test_totals_are_sums_of_records(spark):
    t = load_fixture_tables(spark, SF)
    p = Period.calendar_year(1996)
    records = I.index_records(t, p)
    by_code = {r.FBI_CD: r["count"] for r in records.groupBy("FBI_CD").count().collect()}
    totals = I.index_totals(records).collect()
    for code, n in by_code.items():
        assert sum(r[code] for r in totals) == n
    assert records.count() == records.distinct().count()


def test_period_sweep_records_union(spark):
    t = load_fixture_tables(spark, SF)
    wide = I.index_records(t, Period.calendar_years(1995, 1997))
    parts = [I.index_records(t, Period.calendar_year(y)) for y in (1995, 1996, 1997)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert wide.exceptAll(union).count() == 0 and union.exceptAll(wide).count() == 0


def test_report_invariants(spark):
    t = load_fixture_tables(spark, SF)
    p = Period.calendar_year(1996)
    rep = H.homicide_report(t, p, ordered=False).cache()
    scope = H.homicide_scope(t, p)
    assert rep.agg(F.max("V_COUNT")).first()[0] == scope.select("HOMICIDE_NO").distinct().count()
    # VIC# is gap free inside an incident
    gaps = (rep.groupBy("`CASE#_TYPE1`").agg(F.max("`VIC#`").alias("m"),
                                              F.countDistinct("`CASE#_TYPE2`").alias("n"))
            .where("m != n").count())
    assert gaps == 0
    bf = rep.where(F.col("SIT_CODE").isin("B", "F"))
    assert bf.where(F.col("`OFF#`") != 1).count() == 0
    assert bf.where((F.col("CIRC_CODE") != "81") & ((F.col("OFF_AGE") != "00") | (F.col("OFF_SEX") != "U"))).count() == 0
    rep.unpersist()


def test_period_sweep_homicide_report(spark):
    from crimestats.functions.predicates import ReportingPeriods

    t = load_fixture_tables(spark, SF)
    multi = H.homicide_report(t, ReportingPeriods.calendar_years(1996, 1997), ordered=False)
    singles = [H.homicide_report(t, Period.calendar_year(y), ordered=False)
               .select(F.lit(str(y)).alias("REPORT_PERIOD"), "*") for y in (1996, 1997)]
    union = singles[0].unionByName(singles[1])
    assert multi.count() > 0
    assert multi.exceptAll(union).count() == 0 and union.exceptAll(multi).count() == 0
