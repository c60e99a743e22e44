"""Registered queries: one Spark DataFrame per operator of SURVEY §2.

Each callable takes ``(spark, sf_dir)``, derives the nine input relations from
the whole parquet test tables in ``sf_dir`` (``sources.fixtures``) and returns
a lazy DataFrame.  Report queries use the fixture reporting period, calendar
1996, and districts 1..25; the ``*_all_years`` / ``*_by_year`` variants report
every calendar year the tables span in one run; the ``op_*`` queries apply
one general operator to whole input relations.  ``crimestats.duckdb_checks`` holds the matching oracle.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crimestats.functions import codes as C
from crimestats.functions import recode as R
from crimestats.functions.predicates import (
    DistrictRange,
    Period,
    ReportingPeriods,
    in_period,
    like_any,
    not_like_any,
    numeric_between,
    prefix_not_in,
)
from crimestats.operators import ranking, relational
from crimestats.plans import homicide as H
from crimestats.plans import index_crime as I
from crimestats.schemas import INDEX_CODES
from crimestats.sources.fixtures import load_fixture_tables
from crimestats.sources.tables import CrimeTables

FIXTURE_PERIOD = Period.calendar_year(1996)
FIXTURE_DISTRICTS = DistrictRange(1, 25)
# Every calendar year the test tables span: one run over the whole tables.
ALL_YEARS = (1995, 2001)
#: A year with its halves and three months that lie across them, in one job.
OVERLAPPING = ReportingPeriods(tuple((name, Period(dt.datetime(*start), dt.datetime(*end))) for name, start, end in (
    ("year", (1996, 1, 1), (1997, 1, 1)), ("half1", (1996, 1, 1), (1996, 7, 1)), ("half2", (1996, 7, 1), (1997, 1, 1)),
    ("summer", (1996, 6, 1), (1996, 9, 1)))))
# Small enough that the fixture scales exercise several range buckets.
OP_RANK_KEYS_PER_BUCKET = 4096
SHR_RANK_KEYS_PER_BUCKET = 1000

Query = Callable[[SparkSession, str], DataFrame]


_TABLES: dict[tuple[str, str], CrimeTables] = {}


def _tables(spark: SparkSession, sf_dir: str) -> CrimeTables:
    """Input relations over ``sf_dir``, built once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = load_fixture_tables(spark, sf_dir)
    return _TABLES[key]


def _with_tables(fn: Callable[[CrimeTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


P, D = FIXTURE_PERIOD, FIXTURE_DISTRICTS


# ------------------------------------------------------------------ index crime
def _cb(t: CrimeTables) -> DataFrame:
    return I.case_base(t, P, D)


INDEX_QUERIES: dict[str, Callable[[CrimeTables], DataFrame]] = {
    "idx_case_base": _cb,
    "idx_homicide": lambda t: I.homicide_records(t, P, D),
    "idx_victim": lambda t: I.victim_counted_records(_cb(t), t),
    "idx_incident": lambda t: I.incident_counted_records(_cb(t)),
    "idx_mvt_override": lambda t: I.mvt_override_records(_cb(t), t),
    "idx_larceny": lambda t: I.larceny_remainder_records(_cb(t), t),
    "idx_masked_arson": lambda t: I.masked_arson_records(_cb(t), t),
    "idx_burned_arson": lambda t: I.burned_property_arson_records(_cb(t), t),
    "idx_records": lambda t: I.index_records(t, P, D, method="union"),
    "idx_records_single_pass": lambda t: I.index_records(t, P, D, method="single_pass"),
    "idx_totals": lambda t: I.index_report(t, P, D),
    "idx_records_all_years": lambda t: I.index_records(t, Period.calendar_years(*ALL_YEARS), D),
    "idx_totals_all_years": lambda t: I.index_report(t, Period.calendar_years(*ALL_YEARS), D),
}


# --------------------------------------------------------------------- homicide
def _scope(t: CrimeTables) -> DataFrame:
    return H.homicide_scope(t, P, D)


def _master(t: CrimeTables, distinct: bool = True) -> DataFrame:
    t = H.with_materialized_homicides(t, P, D)
    return H.homicide_master(t, P, D, materialize=True, distinct=distinct).drop(H.PERIOD_COL)


def _master_rows(t: CrimeTables) -> DataFrame:
    """Master rows for queries that take a DISTINCT of a few columns themselves."""
    return _master(t, distinct=False)


def _adjusted(t: CrimeTables) -> DataFrame:
    t = H.with_materialized_homicides(t, P, D)
    master = H.homicide_master(t, P, D, True, SHR_RANK_KEYS_PER_BUCKET, distinct=False)
    return H.homicide_adjusted(master).drop(H.PERIOD_COL)


def _project(fn: Callable[[CrimeTables], DataFrame], cols: list[str]) -> Callable[[CrimeTables], DataFrame]:
    return lambda t: relational.select_distinct(fn(t), [f"`{c}`" for c in cols])


HOMICIDE_QUERIES: dict[str, Callable[[CrimeTables], DataFrame]] = {
    "shr_scope": lambda t: _scope(t).select(
        "ID", "RD_NO", "HOMICIDE_NO", F.date_format("INJURY_DATE", "yyyy-MM-dd HH:mm:ss").alias("INJURY_TS"),
        "CLEARED_I", "INJURY_DESCR"),
    "shr_weapon_codes": lambda t: H.weapon_codes(t, _scope(t), keep_unarmed=True),
    "shr_weapon_top1": lambda t: H.homicide_weapon(t, _scope(t)),
    "shr_party_counts": lambda t: H.party_counts(t, _scope(t)).drop(H.PERIOD_COL),
    "shr_situation": lambda t: H.situation_codes(H.party_counts(t, _scope(t))).drop(H.PERIOD_COL),
    "shr_circumstance": lambda t: H.circumstance_codes(t, P, D).drop(H.PERIOD_COL),
    "shr_master": _master,
    "shr_ccode": _project(_master_rows, ["RD_NO", "HOMICIDE_NO", "CCODE"]),
    "shr_ages": _project(_master_rows, ["HOMICIDE_NO", "VICTIM_AGE", "VICAGE", "HOFFID", "AGE", "OFFAGE"]),
    "shr_victim_demo": _project(_master_rows, ["HOMICIDE_NO", "VICSEX", "VICRACE", "VICETHNICITY"]),
    "shr_offender_demo": _project(_master_rows, ["HOMICIDE_NO", "HOFFID", "SITUATIONCD", "OFFSEX", "OFFRACE",
                                            "OFFETHNICITY"]),
    "shr_relationship": _project(_master_rows, ["HOMICIDE_NO", "SITUATIONCD", "RELATIONCD"]),
    "shr_adjusted": _adjusted,
    "shr_v_count": _project(_adjusted, ["CASE#_TYPE2", "V_COUNT"]),
    "shr_vic_no": _project(_adjusted, ["CASE#_TYPE1", "CASE#_TYPE2", "VIC#"]),
    "shr_off_no": _project(_adjusted, ["CASE#_TYPE2", "SIT_CODE", "HOFFID2", "OFF#"]),
    "shr_report": lambda t: H.homicide_report(t, P, D),
    "shr_report_overlapping": lambda t: H.homicide_report(t, OVERLAPPING, D),
    "shr_report_by_year": lambda t: H.homicide_report(t, ReportingPeriods.calendar_years(*ALL_YEARS), D),
}


# ------------------------------------------------------------ general operators
def _op_crosstab(t: CrimeTables) -> DataFrame:
    lookup = relational.broadcast_if_bounded(t.iucr_codes)
    cr = t.crimes.select("CURR_IUCR", "MONTH", "YEAR")
    joined = cr.join(lookup, cr["CURR_IUCR"] == lookup["CD"], "inner")
    return relational.conditional_count_crosstab(joined, ["YEAR", "MONTH"], "FBI_CD", INDEX_CODES)


def _op_union_distinct(t: CrimeTables) -> DataFrame:
    return relational.union_distinct(
        t.victims.select(F.col("CASE_ID").alias("ID"), F.col("VFBI_CD").alias("CODE")),
        t.case_iucr.select(F.col("CASE_ID").alias("ID"), F.col("IUCR_CODE_CD").alias("CODE")),
    )


def _op_semi(t: CrimeTables) -> DataFrame:
    arson = t.case_iucr.where(F.col("IUCR_CODE_CD").isin(list(C.ARSON_IUCR)))
    return relational.exists_in(t.crimes.select("ID", "RD"), arson, "ID", "CASE_ID")


def _op_not_in(t: CrimeTables) -> DataFrame:
    mvt = t.case_iucr.where(F.col("IUCR_CODE_CD").isin(list(C.MVT_IUCR)))
    return relational.not_in_subquery(t.crimes.select("ID", "RD"), mvt, "ID", "CASE_ID")


def _op_top1(t: CrimeTables) -> DataFrame:
    coded = H.weapon_codes(t, t.homicides)
    return relational.top1_per_key(coded, "HOM_HOMICIDE_ID", ["HIERARCHY", "WEAPID"], ["WEAPON_TYPE", "WEAPON_NAME"])


def _op_distinct_over(t: CrimeTables) -> DataFrame:
    off = t.offenders.select(F.col("HOM_HOMICIDE_ID").alias("_OHID"), F.col("ID").alias("HOFFID"))
    hom = t.homicides.select("ID", "RD_NO", "HOMICIDE_NO")
    rows = relational.left_join_splittable(hom, off, "ID", "_OHID").select("RD_NO", "HOMICIDE_NO", "HOFFID")
    return relational.count_distinct_over(rows, "RD_NO", {"VICTOTAL": "HOMICIDE_NO", "OFFENDERS": "HOFFID"})


def _op_dense_rank(t: CrimeTables) -> DataFrame:
    return ranking.with_dense_rank(t.victims.select("CASE_ID", "NO_ID", "VFBI_CD"), ["NO_ID"], ["CASE_ID"],
                                   rank_col="NO_RANK", keys_per_bucket=OP_RANK_KEYS_PER_BUCKET)


def _op_global_dense_rank(t: CrimeTables) -> DataFrame:
    return ranking.distinct_dense_rank(t.crimes, ["RD"], rank_col="RD_RANK",
                                       keys_per_bucket=OP_RANK_KEYS_PER_BUCKET)


def _op_code_map(t: CrimeTables) -> DataFrame:
    coded = relational.with_codes(t.homicides, "VICTIM_REL_TO_OFFENDER", R.relation_rows(), R.RELATION_FIELDS)
    return coded.select(
        "ID", "VICTIM_RACE", R.victim_race("VICTIM_RACE").alias("VICRACE"),
        R.victim_ethnicity("VICTIM_RACE").alias("VICETHNICITY"),
        R.relationship_code("VICTIM_REL_TO_OFFENDER", "VICTIM_SEX", None).alias("RELATIONCD"),
    )


def _op_like_any(t: CrimeTables) -> DataFrame:
    names = [F.col("VICTIM_LAST_NME"), F.col("VICTIM_FIRST_NME")]
    pats = list(C.POLICE_NAME_PATTERNS)
    return t.homicides.select("ID", like_any(names, pats).alias("NAME_HIT"), not_like_any(names, pats).alias("NAME_MISS"))


def _op_text_band(t: CrimeTables) -> DataFrame:
    return t.homicides.select("ID", "VICTIM_AGE", R.victim_age_band("VICTIM_AGE").alias("VICAGE"),
                              R.offender_age_band("VICTIM_AGE", "TRUE").alias("OFFAGE"))


def _op_swap(t: CrimeTables) -> DataFrame:
    off = t.offenders.select(F.col("HOM_HOMICIDE_ID").alias("_OHID"), F.col("ID").alias("HOFFID"), "SEX", "RACE")
    hom = t.homicides.select("ID", "HOMICIDE_NO", "VICTIM_SEX", "VICTIM_RACE")
    rows = relational.left_join_splittable(hom, off, "ID", "_OHID")
    cls = F.substring("HOMICIDE_NO", 1, 1)
    (vs, os_), (vr, or_) = relational.swap_when(cls == "J", cls != "J", [
        (F.col("VICTIM_SEX"), F.col("SEX")), (F.col("VICTIM_RACE"), F.col("RACE"))])
    return rows.select("ID", "HOFFID", vs.alias("VIC_SEX"), os_.alias("OFF_SEX"), vr.alias("VIC_RACE"),
                       or_.alias("OFF_RACE"))


OP_QUERIES: dict[str, Callable[[CrimeTables], DataFrame]] = {
    "op_in_period": lambda t: t.crimes.where(in_period(F.col("DATEOCC"), P)).select("ID", "MONTH", "YEAR"),
    "op_numeric_between": lambda t: t.crimes.where(numeric_between(F.col("DISTRICT"), D.lo, D.hi))
    .select("ID", "DISTRICT"),
    "op_prefix_filter": lambda t: t.crimes.where(prefix_not_in(F.col("STATUS"), C.EXCLUDED_STATUS_PREFIXES))
    .select("ID", "STATUS"),
    "op_crosstab": _op_crosstab,
    "op_union_distinct": _op_union_distinct,
    "op_semi": _op_semi,
    "op_not_in": _op_not_in,
    "op_top1": _op_top1,
    "op_distinct_over": _op_distinct_over,
    "op_dense_rank": _op_dense_rank,
    "op_global_dense_rank": _op_global_dense_rank,
    "op_code_map": _op_code_map,
    "op_like_any": _op_like_any,
    "op_text_band": _op_text_band,
    "op_swap": _op_swap,
    "op_distinct": lambda t: relational.select_distinct(t.victims, ["CASE_ID", "NO_ID"]),
}

def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (INDEX_QUERIES, HOMICIDE_QUERIES, OP_QUERIES):
        for key, fn in group.items():
            out[key] = _with_tables(fn)
    return out
