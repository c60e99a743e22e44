"""Supplementary homicide report.

One output row per victim x offender of every homicide in the reporting
period: most lethal weapon, situation (victim / offender counts of the
incident), circumstance, relationship and demographic codes, with the roles
of victim and offender swapped for homicides justified by police.

Layers, each a DataFrame function:

``homicide_scope`` (period, active, districts) ->
``weapon_codes`` / ``lethal_weapon`` (one weapon per homicide) ->
``party_counts`` / ``situation_codes`` (per incident RD number) ->
``circumstance_codes`` (per RD number, from motives) ->
``homicide_master`` (recoded victim x offender rows) ->
``homicide_adjusted`` (ranks, role swap, suspect collapse) ->
``homicide_report`` (21 columns, distinct, ordered).

Scale notes.  The top-1 weapon is a ``min`` aggregate, not a window, so a
homicide with very many weapons costs one row per task.  Distinct counts per
incident are grouped aggregates (Spark splits a hot key by value).  The three
dense ranks (over the whole report, within an incident, within a homicide) are
computed on distinct keys by range buckets (``operators.ranking``), never in a
single task.  RD-level joins use distinct (RD, code) pairs, so an incident with
many homicides does not multiply rows by the number of its motives.

The report stages three relations: the period's homicides, the scope with each
homicide's number of offenders, and the parties (homicide x offender).  All that
is per homicide or per incident is attached to the homicides in place: ranks by
windows over range buckets, and one row per incident with its counts, situations
and circumstances.  The parties come last, joined on (homicide, chunk), so a
homicide with most of the offenders is many bounded keys.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crimestats.functions import codes as C
from crimestats.functions import recode as R
from crimestats.functions.predicates import (
    DistrictRange,
    Period,
    ReportingPeriods,
    number_text,
    numeric_between,
    period_of,
    prefix_not_in,
)
from crimestats.operators.ranking import bucket_of, distinct_dense_rank, estimate_distinct, with_row_ranks
from crimestats.operators.relational import count_distinct_per_key, swap_when, top1_per_key, with_codes
from crimestats.schemas import INPUT_SCHEMAS, SHR_COLUMNS
from crimestats.session import staged_parquet
from crimestats.sources.tables import CrimeTables

DEFAULT_PERIOD = Period.calendar_year(2016)
DEFAULT_DISTRICTS = DistrictRange(1, 25)
# Label of the reporting period a homicide belongs to; every incident-level key
# (counts, situations, circumstances, ranks) includes it, so one run can build
# the reports of many periods (``ReportingPeriods``) with per-period results.
PERIOD_COL = "REPORT_PERIOD"
# Offenders that meet one homicide row at one join key.
OFFENDERS_PER_CHUNK = 100_000
# Homicides with more offenders than a chunk and than one in so many of all offenders meet them by broadcast: at most so many.
MOST_HOT_HOMICIDES = 10_000

# Fixed column contract of the master.
MASTER_COLUMNS = [
    "MNTH", "YR", "TIMEMIL", "WEAPID", "HOMTYPECD", "CLEARED_I", "SITUATIONCD", "CCODE", "DEATH_CAUSE_CD",
    "MOTIVE_DESCR", "HOM_HOMICIDE_ID", "INJURY_DESCR", "WEAPON_TYPE", "WEAPON_NAME", "WEAPONCD", "VICCNT",
    "OFFCNT", "RD_NO", "HOMICIDE_NO", "VICTIM_LAST_NME", "VICTIM_FIRST_NME", "VICAGE", "VICTIM_AGE", "VICSEX",
    "VICTIM_SEX", "VICRACE", "VICTIM_RACE", "VICETHNICITY", "HOFFID", "OFFAGE", "AGE", "OFFSEX", "SEX",
    "OFFRACE", "RACE", "OFFETHNICITY", "LAST_NME", "FIRST_NME", "RELATIONCD",
]


# ----------------------------------------------------------------- H0 scope
def in_periods(df: DataFrame, date: str, periods: ReportingPeriods) -> DataFrame:
    """Rows of ``df`` in a period with its label, ``REPORT_PERIOD``: once for
    each period that holds the date, so overlapping reports share one job.

    The covering period is pushed to the scan.  The moments at which the holding
    periods change are one sorted array in which the date is found by bisection,
    so a row costs the logarithm of the number of periods."""
    scoped = df.where(period_of(df, date, periods.covering()))
    steps = periods.intervals()
    place = bucket_of([date], [(False, t) for t, _ in steps], df.schema)
    labels = F.from_json(F.lit(json.dumps([names for _, names in steps])), "array<array<string>>")
    return scoped.withColumn(PERIOD_COL, F.explode(F.get(labels, place - 1)))


def homicide_base(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                  districts: DistrictRange = DEFAULT_DISTRICTS) -> DataFrame:
    """Homicides injured in the (covering) period and in the district range,
    any class, active or not: the one relation both the report scope (H0) and
    the circumstance codes (H5) are filtered from."""
    periods = ReportingPeriods.of(period)
    hom = tables.homicides
    return hom.where(period_of(hom, "INJURY_DATE", periods.covering()) & numeric_between(F.col("CURR_DISTRICT"), districts.lo, districts.hi))


def with_materialized_homicides(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                                districts: DistrictRange = DEFAULT_DISTRICTS) -> CrimeTables:
    """``tables`` with ``homicides`` replaced by ``homicide_base``, cut to the
    declared columns and staged as Parquet in ``spark.checkpoint.dir``: the
    report's branches then read the period's rows and the columns they need,
    and the table is scanned once."""
    base = homicide_base(tables, period, districts).select(*INPUT_SCHEMAS["homicides"].names)
    return replace(tables, homicides=staged_parquet(base, "homicides"))


def homicide_scope(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                   districts: DistrictRange = DEFAULT_DISTRICTS, active: bool = True) -> DataFrame:
    """H0: homicides injured in the period, active, in the district range; all
    classes, justified and involuntary included.  Adds ``REPORT_PERIOD``."""
    periods = ReportingPeriods.of(period)
    hom = tables.homicides
    cond = numeric_between(F.col("CURR_DISTRICT"), districts.lo, districts.hi)
    if active:
        cond = cond & (F.col("ACTIVE_I") == "Y")
    return in_periods(hom.where(cond), "INJURY_DATE", periods)


# ---------------------------------------------------------------- H1, H2 weapons
def weapon_codes(tables: CrimeTables, scope: DataFrame, keep_unarmed: bool = False) -> DataFrame:
    """H1: every weapon of a homicide in scope with its hierarchy code.

    ``keep_unarmed`` also lists homicides without a weapon row (weapon columns
    NULL, code from the injury alone).  Those rows carry no homicide id, so they
    never reach the report (SURVEY T18); the report uses the inner form.
    """
    weap = tables.weapons.select("HOM_HOMICIDE_ID", F.col("ID").alias("WEAPID"), "WEAPON_TYPE", "WEAPON_NAME")
    hom = scope.select(F.col("ID").alias("_HID"), "HOMICIDE_NO", "INJURY_DESCR")
    joined = weap.join(hom, weap["HOM_HOMICIDE_ID"] == hom["_HID"], "right" if keep_unarmed else "inner")
    return joined.select(
        "HOM_HOMICIDE_ID", "WEAPID", "HOMICIDE_NO", "INJURY_DESCR", "WEAPON_TYPE", "WEAPON_NAME",
        R.weapon_code("INJURY_DESCR", "WEAPON_TYPE", "WEAPON_NAME").alias("HIERARCHY"),
    )


def lethal_weapon(weapons: DataFrame) -> DataFrame:
    """H2: the most lethal weapon per homicide: smallest code, NULL last,
    smallest weapon id among equals (SURVEY T9, T24)."""
    armed = weapons.where(F.col("HOM_HOMICIDE_ID").isNotNull())
    return top1_per_key(armed, "HOM_HOMICIDE_ID", ["HIERARCHY", "WEAPID"],
                        ["HOMICIDE_NO", "INJURY_DESCR", "WEAPON_TYPE", "WEAPON_NAME"])


def homicide_weapon(tables: CrimeTables, scope: DataFrame) -> DataFrame:
    """H2 on the report's path: weapons are first reduced to the smallest id per
    (homicide, type, name), combined before the shuffle, so a homicide with very
    many weapon rows reaches the join as few rows.  The code depends on type,
    name and injury only, so the result is the one of all weapon rows."""
    few = tables.weapons.groupBy("HOM_HOMICIDE_ID", "WEAPON_TYPE", "WEAPON_NAME").agg(F.min("ID").alias("ID"))
    return lethal_weapon(weapon_codes(replace(tables, weapons=few), scope))


# --------------------------------------------------------- H3, H4 situation
def scoped_offenders(tables: CrimeTables, scope: DataFrame, materialize: bool = False) -> DataFrame:
    """Every offender of a homicide in scope, with the homicide's keys.  An inner
    join, so AQE can split a homicide that holds most offender rows; homicides
    without offenders are handled by callers.  ``materialize`` stages the rows,
    so that counts, ranks and the master scan ``offenders`` once."""
    off = tables.offenders.select(F.col("HOM_HOMICIDE_ID").alias("_OHID"), F.col("ID").alias("HOFFID"),
                                  "LAST_NME", "FIRST_NME", "AGE", "SEX", "RACE")
    s = scope.select("ID", PERIOD_COL, "RD_NO", "HOMICIDE_NO")
    rows = s.join(off, s["ID"] == off["_OHID"], "inner").drop("_OHID")
    return staged_parquet(rows, "offenders") if materialize else rows


def _party_keys(scope: DataFrame, offenders: DataFrame) -> DataFrame:
    """(REPORT_PERIOD, RD_NO, HOMICIDE_NO, HOFFID): every homicide in scope with
    a NULL offender, plus every (homicide, offender) pair.  The distinct keys
    of ``scope LEFT JOIN offenders`` plus a NULL key per homicide that has
    offenders -- harmless for distinct counts (NULL is not counted) and for
    offender ranks (NULLS LAST) -- without an outer join."""
    p = PERIOD_COL
    return scope.select(p, "RD_NO", "HOMICIDE_NO", F.lit(None).cast("long").alias("HOFFID")) \
        .unionByName(offenders.select(p, "RD_NO", "HOMICIDE_NO", "HOFFID"))


def party_counts(tables: CrimeTables, scope: DataFrame, offenders: DataFrame | None = None) -> DataFrame:
    """H3: per incident (RD_NO) the distinct victims VICTOTAL and distinct
    offenders OFFENDERS, at (RD_NO, HOMICIDE_NO, CLEARED_I) grain.  OFFTOTAL is
    the ratio, for display only; decisions compare the integer counts (T11).

    Both counts are one grouped aggregate over the party keys; NULL RD numbers
    form one group, as in a window, so the join back is null-safe."""
    p = PERIOD_COL
    offenders = scoped_offenders(tables, scope) if offenders is None else offenders
    counts = count_distinct_per_key(_party_keys(scope, offenders), [p, "RD_NO"],
                                    {"VICTOTAL": "HOMICIDE_NO", "OFFENDERS": "HOFFID"})
    counts = counts.select(F.col(p).alias("_P"), F.col("RD_NO").alias("_RD"), "VICTOTAL", "OFFENDERS")
    grain = scope.select(p, "RD_NO", "HOMICIDE_NO", "CLEARED_I").distinct()
    cond = grain["RD_NO"].eqNullSafe(counts["_RD"]) & grain[p].eqNullSafe(counts["_P"])
    joined = grain.join(counts, cond, "inner")
    return joined.select(
        p, "RD_NO", "HOMICIDE_NO", "CLEARED_I", "VICTOTAL", "OFFENDERS",
        (F.col("OFFENDERS").cast("double") / F.col("VICTOTAL").cast("double")).alias("OFFTOTAL"),
    )


def _situation_sql(cleared: str, excluded: str) -> str:
    """H4 decision table over VICTOTAL (v), OFFENDERS (o), whether the homicide
    is cleared and whether it is involuntary / justified.

    known offender: cleared, or not cleared but involuntary / justified;
    unknown offender: not cleared and neither.  The source compares the ratio
    o/v with 1; on integer counts that is o = v, o > v, o >= v (T11)."""
    known = f"({cleared} = 'Y' OR ({cleared} = 'N' AND {excluded}))"
    unknown = f"({cleared} = 'N' AND NOT ({excluded}))"
    return R.sql_case([
        (f"{known} AND VICTOTAL = 1 AND OFFENDERS = VICTOTAL", "'A'"),
        (f"{known} AND VICTOTAL = 1 AND OFFENDERS > VICTOTAL", "'C'"),
        (f"{known} AND VICTOTAL > 1 AND OFFENDERS = VICTOTAL", "'D'"),
        (f"{known} AND VICTOTAL > 1 AND OFFENDERS > VICTOTAL", "'E'"),
        (f"{unknown} AND VICTOTAL = 1 AND OFFENDERS >= VICTOTAL", "'B'"),
        (f"{unknown} AND VICTOTAL > 1 AND OFFENDERS >= VICTOTAL", "'F'"),
    ])


def situation_code_expr() -> F.Column:
    return F.expr(_situation_sql("CLEARED_I", R.first_char_in("HOMICIDE_NO", C.HOMICIDE_EXCLUDED_CLASSES)))


def situation_codes(counts: DataFrame) -> DataFrame:
    """H4: distinct (RD_NO, SITCODE); an incident can carry several."""
    return counts.select(PERIOD_COL, "RD_NO", situation_code_expr().alias("SITCODE")).distinct()


# ------------------------------------------------------------ H5 circumstance
def circumstance_codes(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                       districts: DistrictRange = DEFAULT_DISTRICTS) -> DataFrame:
    """H5: motive -> circumstance code for every non-involuntary, non-justified
    homicide in the period and districts; inactive ones included (T13)."""
    periods = ReportingPeriods.of(period)
    hom = tables.homicides
    scoped = in_periods(hom.where(
        prefix_not_in(F.col("HOMICIDE_NO"), C.HOMICIDE_EXCLUDED_CLASSES)
        & numeric_between(F.col("CURR_DISTRICT"), districts.lo, districts.hi)
    ), "INJURY_DATE", periods)
    return scoped.select(PERIOD_COL, "RD_NO", "DEATH_CAUSE_CD", "VICTIM_AGE",
                         R.circumstance_code("DEATH_CAUSE_CD", "VICTIM_AGE").alias("CIRCUMSTANCECODE"))


# ------------------------------------------------------------------ ranks
def report_ranks(tables: CrimeTables, scope: DataFrame, offenders: DataFrame | None = None,
                 keys_per_bucket: int | None = None) -> dict[str, DataFrame]:
    """The three dense ranks of the report, as key -> rank maps, per period.

    V_COUNT: HOMICIDE_NO over the whole report; VIC#: HOMICIDE_NO within RD_NO;
    OFF#: offender id within HOMICIDE_NO, NULLS LAST.  The OFF# keys are the
    offender pairs plus (homicide, NULL) for every homicide: the NULL key then
    ranks after all of a homicide's offenders, which is exactly its rank for a
    homicide row without offenders -- no outer join needed for the keys.
    """
    p = PERIOD_COL
    off_keys = _party_keys(scope, scoped_offenders(tables, scope) if offenders is None else offenders)
    sizes = estimate_distinct(off_keys, {"v": [p, "HOMICIDE_NO"], "vic": [p, "RD_NO", "HOMICIDE_NO"],
                                         "off": [p, "HOMICIDE_NO", "HOFFID"]})
    v_count = distinct_dense_rank(scope, ["HOMICIDE_NO"], [p], "V_COUNT", keys_per_bucket, sizes["v"])
    vic_no = distinct_dense_rank(scope, ["HOMICIDE_NO"], [p, "RD_NO"], "VIC_NO", keys_per_bucket, sizes["vic"])
    off_no = distinct_dense_rank(off_keys, ["HOFFID"], [p, "HOMICIDE_NO"], "OFF_RANK", keys_per_bucket, sizes["off"])
    return {"v_count": v_count, "vic_no": vic_no, "off_no": off_no}


def _join_rank(df: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, NULL keys equal."""
    renamed = ranks.select(*(F.col(k).alias(f"_r_{k}") for k in keys),
                           *(c for c in ranks.columns if c not in keys))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, "inner").drop(*(f"_r_{k}" for k in keys))


# ------------------------------------------------------------------ H6 master
def sized_scope(tables: CrimeTables, scope: DataFrame) -> DataFrame:
    """The scope with OFFENDER_ROWS, a homicide's number of offender rows (NULL: none), and CHUNKS, the keys they are dealt to."""
    rows = tables.offenders.where(F.col("HOM_HOMICIDE_ID").isNotNull()).groupBy(F.col("HOM_HOMICIDE_ID").alias("_OHID")) \
        .agg(F.count(F.lit(1)).alias("OFFENDER_ROWS"))
    sized = scope.join(rows, scope["ID"] == rows["_OHID"], "left").drop("_OHID")
    return sized.withColumn("CHUNKS", F.ceil(F.coalesce("OFFENDER_ROWS", F.lit(1)) / OFFENDERS_PER_CHUNK).cast("long"))


def scoped_parties(tables: CrimeTables, sized: DataFrame) -> DataFrame:
    """Every homicide of the scope with each of its offenders, or once with none:
    the homicide's keys, the offender's columns, and the CHUNK it is dealt to.

    Homicides with more offenders than a chunk and than one in
    MOST_HOT_HOMICIDES of all meet their offenders by broadcast, where these
    lie; as the counts add up, there are at most MOST_HOT_HOMICIDES of them.  The
    others are joined by a shuffle in which no key is larger than that."""
    p = PERIOD_COL
    keys = sized.select("ID", p, "RD_NO", "HOMICIDE_NO", "CHUNKS", "OFFENDER_ROWS")
    off = tables.offenders.select(F.col("HOM_HOMICIDE_ID").alias("_OHID"), F.col("ID").alias("HOFFID"),
                                  "LAST_NME", "FIRST_NME", "AGE", "SEX", "RACE")
    facts = keys.agg(F.sum("OFFENDER_ROWS").alias("n"), F.max("OFFENDER_ROWS").alias("most")).collect()[0]
    hot_from = max(OFFENDERS_PER_CHUNK, (facts["n"] or 0) // MOST_HOT_HOMICIDES)
    with_any, none = keys.where("OFFENDER_ROWS IS NOT NULL"), keys.where("OFFENDER_ROWS IS NULL")
    if (facts["most"] or 0) <= hot_from:
        matched = with_any.join(off, with_any["ID"] == off["_OHID"], "inner")
    else:
        hot, cold = with_any.where(F.col("OFFENDER_ROWS") > hot_from), with_any.where(F.col("OFFENDER_ROWS") <= hot_from)
        hot = F.broadcast(hot)
        names = F.broadcast(hot.select(F.col("ID").alias("_HOT")))
        rest = off.join(names, off["_OHID"] == names["_HOT"], "left_anti")
        matched = off.join(hot, off["_OHID"] == hot["ID"], "inner").unionByName(cold.join(rest, cold["ID"] == rest["_OHID"], "inner"))
    parties = matched.drop("_OHID").unionByName(none, allowMissingColumns=True)
    chunk = F.pmod(F.xxhash64("HOFFID"), F.col("CHUNKS"))
    return parties.withColumn("CHUNK", chunk).drop("CHUNKS", "OFFENDER_ROWS")


def incidents(tables: CrimeTables, scope: DataFrame, parties: DataFrame, period: Period | ReportingPeriods,
              districts: DistrictRange) -> DataFrame:
    """H3 to H5 for the report, one row per incident with an RD number: (_P, _RD,
    SITCODES, CIRCUMSTANCES), the distinct codes as arrays.

    One aggregate over three kinds of rows, combined in the map tasks: victims
    with whether they are cleared and of which class (nine states at most),
    offenders, and circumstance codes ('' for a NULL one, which counts beside
    others).  An incident without a circumstance has one NULL."""
    p = PERIOD_COL
    excluded = F.expr(R.first_char_in("HOMICIDE_NO", C.HOMICIDE_EXCLUDED_CLASSES))
    state = F.struct(F.when(F.col("CLEARED_I").isin("Y", "N"), F.col("CLEARED_I")).alias("CLEARED_I"), excluded.alias("EXCLUDED"))
    circ = circumstance_codes(tables, period, districts)
    rows = scope.select(p, "RD_NO", F.col("HOMICIDE_NO").alias("VICTIM"), state.alias("STATE")) \
        .unionByName(parties.select(p, "RD_NO", "HOFFID"), allowMissingColumns=True) \
        .unionByName(circ.select(p, "RD_NO", F.coalesce("CIRCUMSTANCECODE", F.lit("")).alias("CIRC")), allowMissingColumns=True)
    found = rows.where(F.col("RD_NO").isNotNull()).groupBy(F.col(p).alias("_P"), F.col("RD_NO").alias("_RD")).agg(
        F.count_distinct("VICTIM").alias("VICTOTAL"), F.count_distinct("HOFFID").alias("OFFENDERS"),
        F.collect_set("STATE").alias("STATES"), F.collect_set("CIRC").alias("CIRCS"))
    codes = f"array_distinct(transform(STATES, s -> {_situation_sql('s.CLEARED_I', 's.EXCLUDED')}))"
    circs = "CASE WHEN size(CIRCS) = 0 THEN array(CAST(NULL AS STRING)) ELSE transform(CIRCS, c -> nullif(c, '')) END"
    return found.select("_P", "_RD", F.expr(codes).alias("SITCODES"), F.expr(circs).alias("CIRCUMSTANCES"))


def _homicide_rows(tables: CrimeTables, sized: DataFrame, parties: DataFrame, period: Period | ReportingPeriods,
                   districts: DistrictRange, keys_per_bucket: int | None) -> DataFrame:
    """The scope with all that is per homicide or per incident: lethal weapon,
    VIC# and V_COUNT, and the situations and circumstances of its incident."""
    p = PERIOD_COL
    hom = sized.select(
        "ID", p, "RD_NO", "HOMICIDE_NO", "INJURY_DATE", "CLEARED_I", "DEATH_CAUSE_CD", "MOTIVE_DESCR",
        "INJURY_DESCR", "VICTIM_LAST_NME", "VICTIM_FIRST_NME", "VICTIM_AGE", "VICTIM_SEX", "VICTIM_RACE",
        "VICTIM_REL_TO_OFFENDER", "CHUNKS",
    )
    weapon = homicide_weapon(tables, sized).select(
        F.col("HOM_HOMICIDE_ID"), "WEAPID", "WEAPON_TYPE", "WEAPON_NAME", F.col("HIERARCHY").alias("WEAPONCD"))
    hom = hom.join(weapon, hom["ID"] == weapon["HOM_HOMICIDE_ID"], "left")
    sizes = estimate_distinct(sized, {"v": [p, "HOMICIDE_NO"], "vic": [p, "RD_NO", "HOMICIDE_NO"]}, sized.columns)
    # The ranks read their boundaries and counts from the staged scope, not from the joined rows.
    hom = with_row_ranks(hom, ["HOMICIDE_NO"], [p], "V_COUNT", keys_per_bucket, sizes["v"], sized)
    hom = with_row_ranks(hom, ["HOMICIDE_NO"], [p, "RD_NO"], "VICCNT", keys_per_bucket, sizes["vic"], sized)
    codes = incidents(tables, sized, parties, period, districts)
    hom = hom.join(codes, (hom[p] == codes["_P"]) & (hom["RD_NO"] == codes["_RD"]), "left").drop("_P", "_RD")
    return hom.withColumn("SITCODE", F.explode_outer("SITCODES")).withColumn("CIRCUMSTANCECODE", F.explode_outer("CIRCUMSTANCES")) \
        .drop("SITCODES", "CIRCUMSTANCES")


def _join_parties(hom: DataFrame, parties: DataFrame, keys_per_bucket: int | None) -> DataFrame:
    """``hom`` with its parties and their ``OFFCNT``, on (homicide, chunk): the
    homicide is repeated for each of its chunks, so no key of the join is larger
    than a chunk, however many offenders a homicide has.  Every homicide has a
    party, so an inner join does, which AQE can split as well.  The row without
    offender ranks after the offenders of its homicide number."""
    p = PERIOD_COL
    size = estimate_distinct(parties, {"off": [p, "HOMICIDE_NO", "HOFFID"]}, parties.columns)["off"]
    ranked = with_row_ranks(parties.drop("RD_NO"), ["HOFFID"], [p, "HOMICIDE_NO"], "OFFCNT", keys_per_bucket, size)
    hom = hom.withColumn("CHUNK", F.expr("explode(sequence(0L, CHUNKS - 1))")).drop("CHUNKS")
    return _join_rank(hom, ranked, ["ID", p, "HOMICIDE_NO", "CHUNK"])


def homicide_master(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                    districts: DistrictRange = DEFAULT_DISTRICTS, materialize: bool = False,
                    keys_per_bucket: int | None = None, distinct: bool = True) -> DataFrame:
    """H6: recoded victim x offender rows (39 columns + ``REPORT_PERIOD``), as a set.

    The master is only ever consumed through DISTINCT, so it is built from
    distinct (RD, situation) and (RD, circumstance) pairs: identical result,
    without multiplying an incident's rows by its number of motives.  With
    ``distinct=False`` (the report's path) the rows also carry ``V_COUNT``,
    and DISTINCT is left to the consumer.  ``materialize`` stages the scope
    (``sized_scope``) and its parties (``scoped_parties``).
    """
    p = PERIOD_COL
    stage = staged_parquet if materialize else (lambda df, _name: df)
    sized = stage(sized_scope(tables, homicide_scope(tables, period, districts)), "scope")
    parties = stage(scoped_parties(tables, sized), "parties")
    rows = _join_parties(_homicide_rows(tables, sized, parties, period, districts, keys_per_bucket), parties, keys_per_bucket)
    shown = R.offender_shown("SITCODE", "LAST_NME")
    rows = with_codes(rows, "VICTIM_REL_TO_OFFENDER", R.relation_rows(), R.RELATION_FIELDS)
    master = rows.select(
        number_text(F.month("INJURY_DATE"), 2).alias("MNTH"),
        number_text(F.year("INJURY_DATE"), 4).alias("YR"),
        F.concat(number_text(F.hour("INJURY_DATE"), 2), number_text(F.minute("INJURY_DATE"), 2)).alias("TIMEMIL"),
        "WEAPID",
        R.homicide_type("HOMICIDE_NO").alias("HOMTYPECD"),
        "CLEARED_I",
        F.col("SITCODE").alias("SITUATIONCD"),
        R.circumstance_class("HOMICIDE_NO", "VICTIM_LAST_NME", "VICTIM_FIRST_NME", "CIRCUMSTANCECODE").alias("CCODE"),
        "DEATH_CAUSE_CD", "MOTIVE_DESCR", "HOM_HOMICIDE_ID", "INJURY_DESCR", "WEAPON_TYPE", "WEAPON_NAME",
        "WEAPONCD", "VICCNT", "OFFCNT", "RD_NO", "HOMICIDE_NO", "VICTIM_LAST_NME", "VICTIM_FIRST_NME",
        R.victim_age_band("VICTIM_AGE").alias("VICAGE"), "VICTIM_AGE",
        R.victim_sex("VICTIM_SEX").alias("VICSEX"), "VICTIM_SEX",
        R.victim_race("VICTIM_RACE").alias("VICRACE"), "VICTIM_RACE",
        R.victim_ethnicity("VICTIM_RACE").alias("VICETHNICITY"),
        "HOFFID",
        R.offender_age_band("AGE", shown).alias("OFFAGE"), "AGE",
        R.offender_sex("SEX", shown).alias("OFFSEX"), "SEX",
        R.offender_race("RACE", shown).alias("OFFRACE"), "RACE",
        R.offender_ethnicity("RACE", shown).alias("OFFETHNICITY"),
        "LAST_NME", "FIRST_NME",
        R.relationship_code("VICTIM_REL_TO_OFFENDER", "VICTIM_SEX", "SITCODE").alias("RELATIONCD"),
        p,
        "V_COUNT",
    )
    return master.select(*MASTER_COLUMNS, p).distinct() if distinct else master


# ---------------------------------------------------------------- H7 adjusted
def homicide_adjusted(master: DataFrame, distinct: bool = True) -> DataFrame:
    """H7: report columns plus HOFFID2 (and ``REPORT_PERIOD``), distinct
    (``distinct=False`` when the consumer deduplicates anyway).

    Input: master rows with ``V_COUNT`` (``homicide_master(distinct=False)``).
    V_COUNT / VIC# / OFF# ranks; one suspect row for unknown-offender
    situations (B, F); police-shooting weapon override; victim and offender
    roles exchanged when CCODE is '81' (SURVEY §2.4.8)."""
    sit, ccode = F.col("SITUATIONCD"), F.col("CCODE")
    unknown_offender = sit.isin(list(C.UNKNOWN_OFFENDER_SITUATIONS))
    police = ccode == C.POLICE_CIRCUMSTANCE
    (vic_age, off_age), (vic_sex, off_sex), (vic_race, off_race), (vic_eth, off_eth) = swap_when(
        police, ccode != C.POLICE_CIRCUMSTANCE,
        [(F.col("VICAGE"), F.col("OFFAGE")), (F.col("VICSEX"), F.col("OFFSEX")),
         (F.col("VICRACE"), F.col("OFFRACE")), (F.col("VICETHNICITY"), F.col("OFFETHNICITY"))],
    )
    injury = F.col("INJURY_DESCR")
    adjusted = master.select(
        F.col("MNTH").alias("MONTH"),
        F.col("YR").alias("YEAR"),
        F.col("RD_NO").alias("CASE#_TYPE1"),
        F.col("HOMICIDE_NO").alias("CASE#_TYPE2"),
        F.when(unknown_offender, F.lit(1).cast("long")).otherwise(F.col("HOFFID")).alias("HOFFID2"),
        F.col("V_COUNT").cast("long").alias("V_COUNT"),
        F.col("HOMTYPECD").alias("HOM_TYPE"),
        sit.alias("SIT_CODE"),
        ccode.alias("CIRC_CODE"),
        F.lit(" ").alias("CIRC_SUBCODE"),
        F.when(police & (injury == "SHOT"), F.lit("12"))
         .when(police & (injury != "SHOT"), F.lit(" "))
         .otherwise(F.col("WEAPONCD")).alias("WEAP_CODE"),
        F.col("VICCNT").cast("long").alias("VIC#"),
        vic_age.alias("VIC_AGE"), vic_sex.alias("VIC_SEX"), vic_race.alias("VIC_RACE"), vic_eth.alias("VIC_ETH"),
        F.when(unknown_offender, F.lit(1).cast("long")).otherwise(F.col("OFFCNT").cast("long")).alias("OFF#"),
        off_age.alias("OFF_AGE"), off_sex.alias("OFF_SEX"), off_race.alias("OFF_RACE"), off_eth.alias("OFF_ETH"),
        F.col("RELATIONCD").alias("REL_CODE"),
        PERIOD_COL,
    )
    return adjusted.distinct() if distinct else adjusted


# ------------------------------------------------------------------ H8 report
def homicide_report(tables: CrimeTables, period: Period | ReportingPeriods = DEFAULT_PERIOD,
                    districts: DistrictRange = DEFAULT_DISTRICTS, ordered: bool = True,
                    materialize: bool = True) -> DataFrame:
    """H8: the supplementary homicide report, 21 columns, distinct, ordered by
    CASE#_TYPE2, VIC#, OFF# (NULLS LAST).  For several reporting periods the
    rows of each period's report are labelled by a leading ``REPORT_PERIOD``.

    ``materialize`` stages the period's homicides and their offenders once
    (needs ``spark.checkpoint.dir`` on a cluster); without it every branch
    re-reads the tables."""
    periods = ReportingPeriods.of(period)
    if materialize:
        tables = with_materialized_homicides(tables, periods, districts)
    master = homicide_master(tables, periods, districts, materialize, distinct=False)
    cols = ([PERIOD_COL] if periods.labelled else []) + list(SHR_COLUMNS)
    report = homicide_adjusted(master, distinct=False).select(*(F.col(f"`{c}`") for c in cols)).distinct()
    if ordered:
        report = report.orderBy(*([F.col(PERIOD_COL)] if periods.labelled else []),
                                F.col("`CASE#_TYPE2`").asc_nulls_last(), F.col("`VIC#`").asc_nulls_last(),
                                F.col("`OFF#`").asc_nulls_last())
    return report
