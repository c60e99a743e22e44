"""Index crime reporting: reportable records and monthly totals.

Two formulations of the record set:

* ``index_records(..., method="union")`` -- one DataFrame per reporting rule
  (homicides, victim-counted, incident-counted, MVT override, larceny
  remainder, masked arson, burned-property arson) and a set union, the way
  the rules are stated.
* ``index_records(..., method="single_pass")`` (default, used by the totals) --
  ``case_iucr`` and ``properties`` are read once: the case-level evidence
  (has a motor-vehicle-theft code, an arson code, a criminal-damage code, a
  burned property) is aggregated per case *before* the shuffle, left-joined
  to the scoped cases, and every rule becomes an array element that is
  exploded.  Victim-counted records come from one inner join with
  ``victims`` (so AQE can split a case with a huge number of victims).

In both the case base is staged once as Parquet (``materialize``), so ``crimes``
is scanned once however many rules read the cases; the rule-by-rule form stages
the case codes that any rule asks for as well, so ``case_iucr`` is scanned once.

The set is put together by parts that share no code: homicides (01A), victim
counts (02, 04A, 04B), cases (the other codes).  Each part is made distinct by
its own keys: homicides before their constants, victims and cases before they are
joined, case records where the joins by case id have put them.

Records are the 6-tuple (ID, RD, NO_ID, FBI_CD, MONTH, YEAR) with set semantics.
Crime MONTH / YEAR are the stored columns; homicide ones come from the injury date.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crimestats.functions import codes as C
from crimestats.functions.recode import q, sql_in
from crimestats.functions.predicates import (
    DistrictRange,
    Period,
    number_text,
    numeric_between,
    period_of,
    prefix_not_in,
)
from crimestats.operators.relational import (
    conditional_count_crosstab,
    disjoint_union,
    exists_in,
    is_bounded,
    not_in_subquery,
    passing,
    union_distinct,
)
from crimestats.schemas import INDEX_CODES
from crimestats.session import staged_parquet
from crimestats.sources.tables import CrimeTables

DEFAULT_PERIOD = Period.calendar_year(2016)
DEFAULT_DISTRICTS = DistrictRange(1, 25)
RECORD_COLUMNS = ["ID", "RD", "NO_ID", "FBI_CD", "MONTH", "YEAR"]


def _record(df: DataFrame, no_id: Column | int, code: Column | str, rd: str = "RD") -> DataFrame:
    no_id_col = no_id if isinstance(no_id, Column) else F.lit(no_id)
    code_col = code if isinstance(code, Column) else F.lit(code)
    return df.select(
        F.col("ID"), F.col(rd).alias("RD"), no_id_col.cast("int").alias("NO_ID"),
        code_col.alias("FBI_CD"), F.col("MONTH"), F.col("YEAR"),
    )


# ---------------------------------------------------------------- I0 case base
def code_lookup(tables: CrimeTables) -> DataFrame:
    """IUCR code -> FBI code, plus whether the FBI code is a known FBI code.

    Both are dimension tables: the existence test against ``fbi_codes`` is
    resolved here, on the small side, instead of as a join of the crimes.  The
    result is at most one row per IUCR row (``fbi_codes`` is deduplicated), so
    the size check of ``iucr_codes`` (a scan, no shuffle) bounds the lookup.
    """
    fbi = tables.fbi_codes.select(F.col("CD").alias("_FBI_CD")).distinct()
    iucr = tables.iucr_codes.select("CD", "FBI_CD")
    lookup = iucr.join(fbi, iucr["FBI_CD"] == fbi["_FBI_CD"], "left")
    lookup = lookup.select("CD", "FBI_CD", F.col("_FBI_CD").isNotNull().alias("FBI_KNOWN"))
    return F.broadcast(lookup) if is_bounded(tables.iucr_codes) else lookup


def case_base(tables: CrimeTables, period: Period = DEFAULT_PERIOD,
              districts: DistrictRange = DEFAULT_DISTRICTS) -> DataFrame:
    """Crimes in the period, not unfounded/excluded (status 2x, 7x), with an
    RD number, in the district range, joined to their IUCR code.

    Period, RD and IN-list tests are pushed to the Parquet scan, and on a layout
    by occurrence date the scan lists the period's folders only; the code table
    is broadcast after its size is checked.
    """
    cr = tables.crimes
    scoped = cr.where(
        period_of(cr, "DATEOCC", period)
        & prefix_not_in(F.col("STATUS"), C.EXCLUDED_STATUS_PREFIXES)
        & F.col("RD").isNotNull()
        & numeric_between(F.col("DISTRICT"), districts.lo, districts.hi)
    ).select("ID", "RD", "CURR_IUCR", "LOCATION", "MONTH", "YEAR")
    lookup = code_lookup(tables)
    joined = scoped.join(lookup, scoped["CURR_IUCR"] == lookup["CD"], "inner")
    return joined.select("ID", "RD", "CD", "FBI_CD", "FBI_KNOWN", "LOCATION", "MONTH", "YEAR")


# ------------------------------------------------------------ rule predicates
# Each rule is one SQL predicate over the case-base columns (a single JVM call
# to build; the same Catalyst expression as the equivalent Column chain).
def _sql_victim_counted() -> str:
    return f"{sql_in('FBI_CD', C.VICTIM_COUNTED_CODES)} AND NOT ({sql_in('CD', C.VICTIM_COUNT_EXCLUDED_IUCR)})"


def _sql_incident_counted() -> str:
    return (f"({sql_in('FBI_CD', C.INCIDENT_CODES)} OR (FBI_CD = {q(C.BURGLARY_CODE)}"
            f" AND NOT ({sql_in('LOCATION', C.VEHICLE_LOCATIONS)})))")


def _sql_larceny_population() -> str:
    return (f"(FBI_CD = {q(C.LARCENY_CODE)} OR (FBI_CD = {q(C.BURGLARY_CODE)}"
            f" AND {sql_in('LOCATION', C.VEHICLE_LOCATIONS)})) AND NOT ({sql_in('CD', C.LARCENY_EXCLUDED_IUCR)})")


def _sql_arson_masking() -> str:
    return sql_in("FBI_CD", C.ARSON_MASKING_CODES)


def _sql_not_arson() -> str:
    return f"NOT ({sql_in('FBI_CD', [C.ARSON_CODE])})"


def is_victim_counted() -> Column:
    """Sexual assault, aggravated assault / battery (IUCR 0487 excluded)."""
    return F.expr(_sql_victim_counted())


def is_incident_counted() -> Column:
    """Robbery / MVT / arson, or burglary not from a vehicle (NULL location: neither, T4)."""
    return F.expr(_sql_incident_counted())


def is_larceny_population() -> Column:
    """Larceny, or burglary from a vehicle; IUCR 0840-0843 excluded."""
    return F.expr(_sql_larceny_population())


def is_arson_masking() -> Column:
    return F.expr(_sql_arson_masking())


def is_not_arson() -> Column:
    return F.expr(_sql_not_arson())


# ------------------------------------------------------------ branch operators
def homicide_records(tables: CrimeTables, period: Period = DEFAULT_PERIOD,
                     districts: DistrictRange = DEFAULT_DISTRICTS) -> DataFrame:
    """Murder / non-negligent manslaughter from the homicide table: not
    involuntary or justified, injured in the period, active, in the districts."""
    hom = tables.homicides
    scoped = hom.where(
        prefix_not_in(F.col("HOMICIDE_NO"), C.HOMICIDE_EXCLUDED_CLASSES)
        & period_of(hom, "INJURY_DATE", period)
        & (F.col("ACTIVE_I") == "Y")
        & numeric_between(F.col("CURR_DISTRICT"), districts.lo, districts.hi)
    )
    return scoped.select(
        F.col("ID"), F.col("RD_NO").alias("RD"), F.lit(1).alias("NO_ID"), F.lit(C.HOMICIDE_CODE).alias("FBI_CD"),
        number_text(F.month("INJURY_DATE"), 2).alias("MONTH"), number_text(F.year("INJURY_DATE"), 4).alias("YEAR"),
    )


def victim_counted_records(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """Sexual assault / aggravated assault and battery, one record per
    victim, carrying the *victim's* code (T7)."""
    cases = cb.where(is_victim_counted())
    vic = tables.victims.where(F.col("VFBI_CD").isin(list(C.VICTIM_COUNTED_CODES))) \
        .select("CASE_ID", "NO_ID", "VFBI_CD")
    joined = cases.join(vic, cases["ID"] == vic["CASE_ID"], "inner")
    return _record(joined, F.col("NO_ID"), F.col("VFBI_CD"))


def victim_record_set(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """I2 as a set: victims and cases are made distinct before they meet.  A pair
    of distinct rows is a distinct record, so the records are not shuffled, and
    the join is free to split a case with very many victims."""
    cases = cb.where(is_victim_counted()).select("ID", "RD", "MONTH", "YEAR").distinct()
    vic = tables.victims.where(F.col("VFBI_CD").isin(list(C.VICTIM_COUNTED_CODES))) \
        .select("CASE_ID", "NO_ID", "VFBI_CD").distinct()
    return _record(cases.join(vic, cases["ID"] == vic["CASE_ID"], "inner"), F.col("NO_ID"), F.col("VFBI_CD"))


def incident_counted_records(cb: DataFrame) -> DataFrame:
    """Robbery, MVT, arson and non-vehicle burglary per incident; the FBI
    code must exist in ``fbi_codes``."""
    return _record(cb.where(is_incident_counted() & F.col("FBI_KNOWN")), 1, F.col("FBI_CD"))


def _mvt_override_cases(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    mvt = tables.case_iucr.where(F.col("IUCR_CODE_CD").isin(list(C.MVT_IUCR)))
    return exists_in(cb.where(is_larceny_population()), mvt, "ID", "CASE_ID")


def mvt_override_records(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """I4: larceny (or vehicle burglary) whose case also carries a motor vehicle
    theft code is reported as MVT '07'."""
    return _record(_mvt_override_cases(cb, tables), 1, C.MVT_CODE).distinct()


def larceny_remainder_records(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """The same larceny population minus the I4 cases (SQL NOT IN) -> '06'."""
    overridden = _mvt_override_cases(cb, tables).select(F.col("ID").alias("OVERRIDDEN_ID"))
    rest = not_in_subquery(cb.where(is_larceny_population()), overridden, "ID", "OVERRIDDEN_ID")
    return _record(rest.select("ID", "RD", "MONTH", "YEAR").distinct(), 1, C.LARCENY_CODE)


def masked_arson_records(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """An arson code on a case whose reported code is more serious adds an
    arson record (arson is exempt from the hierarchy rule)."""
    arson = tables.case_iucr.where(F.col("IUCR_CODE_CD").isin(list(C.ARSON_IUCR)))
    return _record(exists_in(cb.where(is_arson_masking()), arson, "ID", "CASE_ID"), 1, C.ARSON_CODE).distinct()


def burned_property_arson_records(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """Criminal damage to property / vehicle with a burned property is
    arson, unless the case is already reported as arson."""
    damage = tables.case_iucr.where(F.col("IUCR_CODE_CD").isin(list(C.CRIMINAL_DAMAGE_IUCR)))
    burned = tables.properties.where(F.col("BURNED_I") == "Y")
    cases = exists_in(exists_in(cb.where(is_not_arson()), damage, "ID", "CASE_ID"), burned, "ID", "CASE_ID")
    return _record(cases, 1, C.ARSON_CODE).distinct()


# -------------------------------------------------------------- rule by rule
def wanted_case_codes(tables: CrimeTables) -> DataFrame:
    """The case codes that some rule asks for, once each."""
    wanted = C.MVT_IUCR + C.ARSON_IUCR + C.CRIMINAL_DAMAGE_IUCR
    return tables.case_iucr.where(F.expr(f"{sql_in('IUCR_CODE_CD', wanted)} AND CASE_ID IS NOT NULL")) \
        .select("CASE_ID", "IUCR_CODE_CD").distinct()


def incident_records_by_rule(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """I3-I7 as a set, one DataFrame per rule.

    Rules may give the same record only under codes of I3, and for one case id,
    by which the joins of I4, I6 and I7 part their rows.  I3 is parted likewise,
    so their union is made distinct where its rows are.  Larcenies (I5) are the
    only records of their code; cases without an id, which no join keeps, are
    records of I3 of their own."""
    named, nameless = cb.where(F.col("ID").isNotNull()), cb.where(F.col("ID").isNull())
    parts = [
        union_distinct(
            incident_counted_records(named).repartition("ID"), mvt_override_records(named, tables),
            masked_arson_records(named, tables), burned_property_arson_records(named, tables),
        ),
        larceny_remainder_records(cb, tables),
    ]
    if not nameless.isEmpty():
        parts.append(incident_counted_records(nameless).distinct())
    return disjoint_union(*parts)


# -------------------------------------------------------------- single pass
def case_code_evidence(tables: CrimeTables) -> DataFrame:
    """Per case: has an MVT / arson / criminal-damage IUCR code.  The IN filter
    reaches the Parquet scan and the partial aggregate collapses a case's rows
    before the shuffle, so a case with millions of rows ships one row per task
    (and none at all when ``case_iucr`` is bucketed by CASE_ID)."""
    wanted = C.MVT_IUCR + C.ARSON_IUCR + C.CRIMINAL_DAMAGE_IUCR
    return tables.case_iucr.where(F.expr(f"{sql_in('IUCR_CODE_CD', wanted)} AND CASE_ID IS NOT NULL")) \
        .groupBy("CASE_ID").agg(
            F.expr(f"max({sql_in('IUCR_CODE_CD', C.MVT_IUCR)})").alias("HAS_MVT"),
            F.expr(f"max({sql_in('IUCR_CODE_CD', C.ARSON_IUCR)})").alias("HAS_ARSON"),
            F.expr(f"max({sql_in('IUCR_CODE_CD', C.CRIMINAL_DAMAGE_IUCR)})").alias("HAS_DAMAGE"),
        )


def burned_property_cases(tables: CrimeTables) -> DataFrame:
    """Cases with a burned property, one row per case (map-side distinct)."""
    return tables.properties.where((F.col("BURNED_I") == "Y") & F.col("CASE_ID").isNotNull()) \
        .select(F.col("CASE_ID").alias("BURNED_CASE_ID")).distinct()


def incident_records_single_pass(cb: DataFrame, tables: CrimeTables) -> DataFrame:
    """I3-I7 as a set, from the scoped cases left-joined with their per-case evidence.

    Both evidence relations have one row per case, so the joins cannot fan
    out; both join on the case id, so ``cb`` is shuffled once (or not at all
    when every case-keyed table is bucketed by case id), and the records are made
    distinct where that left them.  Cases without an id have no evidence: they
    skip the joins, which would put all of them into one task."""
    codes = case_code_evidence(tables)
    burned = burned_property_cases(tables)
    named, nameless = cb.where(F.col("ID").isNotNull()), cb.where(F.col("ID").isNull())
    x = named.join(codes, named["ID"] == codes["CASE_ID"], "left")
    x = x.join(burned, x["ID"] == burned["BURNED_CASE_ID"], "left")
    mvt, arson, damage = "coalesce(HAS_MVT, false)", "coalesce(HAS_ARSON, false)", "coalesce(HAS_DAMAGE, false)"
    burned_flag = "BURNED_CASE_ID IS NOT NULL"
    larceny = _sql_larceny_population()
    candidates = ", ".join([
        f"CASE WHEN {_sql_incident_counted()} AND FBI_KNOWN THEN FBI_CD END",
        f"CASE WHEN {larceny} AND {mvt} THEN {q(C.MVT_CODE)} END",
        f"CASE WHEN {larceny} AND NOT {mvt} THEN {q(C.LARCENY_CODE)} END",
        f"CASE WHEN {_sql_arson_masking()} AND {arson} THEN {q(C.ARSON_CODE)} END",
        f"CASE WHEN {_sql_not_arson()} AND {damage} AND {burned_flag} THEN {q(C.ARSON_CODE)} END",
    ])
    codes_expr = F.expr(f"array_distinct(array_compact(array({candidates})))")
    exploded = x.select("ID", "RD", "MONTH", "YEAR", F.explode(codes_expr).alias("FBI_CD"))
    records = _record(exploded, 1, F.col("FBI_CD")).distinct()
    # Cases without an id are looked for first: the filter on a null id is pushed
    # to the scan, which skips row groups without one.  A larceny case without an
    # id stays only if no case at all is overridden (NOT IN).
    if nameless.isEmpty():
        return records
    overridden = x.where(F.expr(f"{larceny} AND {mvt}")).select(F.lit(1).alias("_one")).limit(1)
    left = nameless.where(F.expr(larceny)).withColumn("_one", F.lit(1)).join(overridden, "_one", "left_anti")
    return disjoint_union(records, incident_counted_records(nameless).distinct(), _record(left, 1, C.LARCENY_CODE).distinct())


# ------------------------------------------------------------------ records
def of_cases(tables: CrimeTables, cb: DataFrame) -> CrimeTables:
    """``tables`` with the case-keyed relations cut to rows whose case may be one
    of ``cb`` (``passing``).  Every rule joins them with ``cb`` by the case id, so
    the records are the same."""
    return replace(tables, **{name: passing(getattr(tables, name), "CASE_ID", cb, "ID") for name in ("victims", "case_iucr", "properties")})


def index_records(tables: CrimeTables, period: Period = DEFAULT_PERIOD,
                  districts: DistrictRange = DEFAULT_DISTRICTS, method: str = "single_pass",
                  materialize: bool = True) -> DataFrame:
    """The reportable record set (unordered, no duplicates).

    ``materialize`` stages the period's cases once (needs
    ``spark.checkpoint.dir`` on a cluster).  Without it each reader of the
    cases scans ``crimes``, which on the bucketed layout saves their shuffle."""
    if method not in ("union", "single_pass"):
        raise ValueError(f"unknown method {method!r}")
    cb = case_base(tables, period, districts)
    if materialize:
        cb = staged_parquet(cb, "cases")
    hom = _record(homicide_records(tables, period, districts).select("ID", "RD", "MONTH", "YEAR").distinct(), 1, C.HOMICIDE_CODE)
    if materialize:
        # Only the staged cases' rows of the case-keyed tables, which carry no date, are shuffled.
        tables = of_cases(tables, cb)
        if method == "union":
            tables = replace(tables, case_iucr=staged_parquet(wanted_case_codes(tables), "case_codes"))
    incidents = incident_records_by_rule if method == "union" else incident_records_single_pass
    return disjoint_union(hom, victim_record_set(cb, tables), incidents(cb, tables))


def index_totals(records: DataFrame) -> DataFrame:
    """Monthly crosstab of the records, one BIGINT count per index code,
    sorted by YEAR, MONTH.  A month without records has no row."""
    return conditional_count_crosstab(records, ["YEAR", "MONTH"], "FBI_CD", INDEX_CODES).orderBy("YEAR", "MONTH")


def index_report(tables: CrimeTables, period: Period = DEFAULT_PERIOD,
                 districts: DistrictRange = DEFAULT_DISTRICTS) -> DataFrame:
    return index_totals(index_records(tables, period, districts))
