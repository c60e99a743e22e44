"""Fixture views: the nine input relations, derived from the driver's test tables.

The reference ships no data, so the reports are exercised on relations derived
from ``orders``, ``lineitem`` and ``customer``: every crime is an order, every
victim / case code / property row a line item, every homicide a customer.  The
derivations shape realistic value mixes (NULL RD numbers, period-edge
timestamps, multi-victim incidents, every order an offender and a weapon); they
are input preparation, not part of any report, and every view covers the
whole source table it is derived from.

The same expression text runs in Spark SQL and in DuckDB (the oracle); only the
timestamp literal keyword differs (``timestamp_ntz`` in Spark so results never
depend on the session time zone, ``timestamp`` in DuckDB).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from crimestats.sources.tables import CrimeTables

# Fixed derivation text (FIXTURES.md §2).  {ts} is the timestamp keyword.
_DATEOCC = (
    "case when o_orderkey % 53 = 0 then {ts} '1996-12-31 23:59:59' "
    "when o_orderkey % 59 = 0 then {ts} '1997-01-01 00:00:00' else o_orderdate end"
)


@dataclass(frozen=True)
class ViewSpec:
    source: str
    columns: tuple[tuple[str, str], ...]
    derived: tuple[tuple[str, str], ...] = ()  # second stage, may use the first stage's columns


VIEWS: dict[str, ViewSpec] = {
    "crimes": ViewSpec(
        source="orders",
        columns=(
            ("ID", "o_orderkey"),
            ("RD", "case when o_orderkey % 97 = 0 then null else 'R' || lpad(cast(o_orderkey as string), 8, '0') end"),
            ("CURR_IUCR", "split_part('0110,0261,0312,051A,0486,0487,0610,0820,0840,0910,0938,1010,1310,1320,0460', ',', cast((o_orderkey) % 15 + 1 as int))"),
            ("DATEOCC", _DATEOCC),
            ("STATUS", "split_part('010,110,200,310,700,400', ',', cast((o_custkey) % 6 + 1 as int))"),
            ("DISTRICT", "lpad(cast(o_custkey % 29 as string), 3, '0')"),
            ("LOCATION", "case when o_orderkey % 4 = 1 then null else split_part('309,290,262,210,126,330,259', ',', cast((o_custkey) % 7 + 1 as int)) end"),
        ),
        derived=(
            ("MONTH", "lpad(cast(month(DATEOCC) as string), 2, '0')"),
            ("YEAR", "cast(year(DATEOCC) as string)"),
        ),
    ),
    "victims": ViewSpec(
        source="lineitem",
        columns=(
            ("CASE_ID", "l_orderkey"),
            ("NO_ID", "l_linenumber"),
            ("VFBI_CD", "split_part('02,04A,04B,08A', ',', cast((l_partkey) % 4 + 1 as int))"),
        ),
    ),
    "case_iucr": ViewSpec(
        source="lineitem",
        columns=(
            ("CASE_ID", "l_orderkey"),
            ("IUCR_CODE_CD", "split_part('0110,0261,0312,051A,0486,0487,0610,0820,0840,0910,0938,1010,1310,1320,0460,0917,1090', ',', cast((l_partkey) % 17 + 1 as int))"),
        ),
    ),
    "properties": ViewSpec(
        source="lineitem",
        columns=(
            ("CASE_ID", "l_orderkey"),
            ("BURNED_I", "case when l_suppkey % 3 = 0 then 'Y' when l_suppkey % 3 = 1 then 'N' else null end"),
        ),
    ),
    "homicides": ViewSpec(
        source="customer",
        columns=(
            ("ID", "c_custkey"),
            ("RD_NO", "'H' || lpad(cast(case when c_custkey % 10 < 6 then c_custkey else c_custkey - c_custkey % 10 + 6 + c_custkey % 2 end as string), 7, '0')"),
            ("HOMICIDE_NO", "split_part('M,M,J,M,I,M,J', ',', cast((c_custkey) % 7 + 1 as int)) || lpad(cast(c_custkey as string), 6, '0')"),
            ("INJURY_DATE", "{ts} '1996-01-01 00:00:00' + ((c_custkey * 104729) % 34560000) * interval '1' second"),
            ("ACTIVE_I", "case when c_custkey % 23 = 0 then 'N' else 'Y' end"),
            ("CURR_DISTRICT", "cast(c_nationkey + 1 + (c_custkey % 3) as string)"),
            ("CLEARED_I", "case when c_custkey % 37 = 0 then null when c_custkey % 10 < 5 then 'Y' else 'N' end"),
            ("DEATH_CAUSE_CD", "split_part('400,840,105,500,155,120,100,140,130,600,300,200,145,900,700,999', ',', cast((c_custkey * 7 + c_nationkey) % 16 + 1 as int))"),
            ("MOTIVE_DESCR", "c_mktsegment"),
            ("INJURY_DESCR", "case when c_custkey % 41 = 0 then null else split_part('SHOT,STABBED,SHOT,STRANGULATION,SHOT,ASPHYXIATION,BEATEN', ',', cast((c_custkey * 3 + c_nationkey) % 7 + 1 as int)) end"),
            ("VICTIM_LAST_NME", "case when c_custkey % 31 = 0 then null else split_part('SMITH,POWELL,P.O. JONES,DOE #7,GARCIA,LEE', ',', cast((c_custkey * 5 + c_nationkey) % 6 + 1 as int)) end"),
            ("VICTIM_FIRST_NME", "case when c_custkey % 29 = 0 or c_custkey % 62 = 0 then null else split_part('ANN,BOB,CAL,DEE', ',', cast((c_custkey) % 4 + 1 as int)) end"),
            ("VICTIM_AGE", "case when c_custkey % 43 = 0 then null else cast((c_custkey * 13) % 103 as int) end"),
            ("VICTIM_SEX", "case when c_custkey % 47 = 0 then null else split_part('M,F,M,X', ',', cast((c_custkey) % 4 + 1 as int)) end"),
            ("VICTIM_RACE", "case when c_custkey % 19 = 0 then null else split_part('API,BLK,WBH,I,WHI,WWH,U,ZZZ', ',', cast((c_custkey) % 8 + 1 as int)) end"),
            ("VICTIM_REL_TO_OFFENDER", "case when c_custkey % 17 = 0 then null else split_part('CHILD,LIFE PARTNER,FRIENDS,WIFE,EX-WIFE,COUSIN,NONE,MARTIAN,MOTHER''S PARAMOUR,BOYFRIEND,NOT ESTABLISHED', ',', cast((c_custkey) % 11 + 1 as int)) end"),
        ),
    ),
    "offenders": ViewSpec(
        source="orders",
        columns=(
            ("ID", "o_orderkey"),
            ("HOM_HOMICIDE_ID", "o_custkey"),
            ("LAST_NME", "case when o_orderkey % 4 = 0 then null else 'OFF' || cast(o_orderkey % 100 as string) end"),
            ("FIRST_NME", "'F' || cast(o_orderkey % 10 as string)"),
            ("AGE", "case when o_orderkey % 13 = 0 then null else cast((o_orderkey * 11) % 103 as int) end"),
            ("SEX", "split_part('M,F,X', ',', cast((o_orderkey) % 3 + 1 as int))"),
            ("RACE", "split_part('API,BLK,WBH,I,WHI,WWH,U,ZZZ', ',', cast((o_orderkey) % 8 + 1 as int))"),
        ),
    ),
    "weapons": ViewSpec(
        source="orders",
        columns=(
            ("ID", "o_orderkey"),
            ("HOM_HOMICIDE_ID", "o_custkey"),
            ("WEAPON_TYPE", "split_part('FIREARM,FIREARM,FIREARM,FIREARM,STABBING/CUTTING,UNKNOWN,BLUDGEON/CLUB,HANDS/FEET,POISON,BURN,DRUG,VEHICLE,LIGATURE,OTHER,FIREARM,OTHER,ALIEN', ',', cast((o_orderkey) % 17 + 1 as int))"),
            ("WEAPON_NAME", "split_part('HANDGUN,RIFLE,SHOTGUN,OTHER,KNIFE,UNKNOWN,BAT,FIST,ARSENIC,FIRE,HEROIN,CAR,ROPE,OTHER,UNKNOWN,WATER (DROWNING),RAY', ',', cast((o_orderkey) % 17 + 1 as int))"),
        ),
    ),
}

# Code dimension tables of the fixtures (FIXTURES.md §2).
IUCR_ROWS = (
    ("0110", "01A"), ("0261", "02"), ("0312", "03"), ("051A", "04A"), ("0486", "04B"), ("0487", "04B"),
    ("0610", "05"), ("0820", "06"), ("0840", "06"), ("0910", "07"), ("0938", "07"), ("1010", "09"),
    ("1310", "14"), ("1320", "14"), ("0460", "08B"),
)
FBI_ROWS = ("01A", "02", "03", "04A", "04B", "05", "06", "07", "09", "08B", "14")


def view_sql(name: str, ts_keyword: str) -> str:
    """SELECT text of one fixture view over its raw source table."""
    spec = VIEWS[name]
    cols = ",\n  ".join(f"{expr.format(ts=ts_keyword)} AS {col}" for col, expr in spec.columns)
    sql = f"SELECT\n  {cols}\nFROM {spec.source}"
    if spec.derived:
        extra = ",\n  ".join(f"{expr} AS {col}" for col, expr in spec.derived)
        sql = f"SELECT *,\n  {extra}\nFROM (\n{sql}\n) AS stage1"
    return sql


def code_table_sql() -> dict[str, str]:
    iucr = ", ".join(f"('{cd}', '{fbi}')" for cd, fbi in IUCR_ROWS)
    fbi = ", ".join(f"('{cd}')" for cd in FBI_ROWS)
    return {
        "iucr_codes": f"SELECT CD, FBI_CD FROM (VALUES {iucr}) AS t(CD, FBI_CD)",
        "fbi_codes": f"SELECT CD FROM (VALUES {fbi}) AS t(CD)",
    }


def duckdb_cte_prefix() -> str:
    """``WITH crimes AS (...), ...`` for oracle SQL over the driver's raw views."""
    parts = [f"{name} AS (\n{view_sql(name, 'timestamp')}\n)" for name in VIEWS]
    parts += [f"{name} AS ({sql})" for name, sql in code_table_sql().items()]
    return "WITH " + ",\n".join(parts) + "\n"


# Columns of the driver's test tables that the views read (TESTDATA.md).  A
# declared schema lets Spark skip the footer-reading job of schema inference.
RAW_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
}


def load_fixture_tables(spark: SparkSession, sf_dir: str) -> CrimeTables:
    """The nine input relations over the parquet test tables in ``sf_dir``."""
    raw: dict[str, DataFrame] = {}
    for source in sorted({spec.source for spec in VIEWS.values()}):
        raw[source] = spark.read.schema(RAW_SCHEMAS[source]).parquet(f"{sf_dir.rstrip('/')}/{source}.parquet")

    def view(name: str) -> DataFrame:
        spec = VIEWS[name]
        df = raw[spec.source]
        df = df.selectExpr(*(f"{expr.format(ts='timestamp_ntz')} AS {col}" for col, expr in spec.columns))
        if spec.derived:
            df = df.selectExpr("*", *(f"{expr} AS {col}" for col, expr in spec.derived))
        return df

    # Inline VALUES tables are local relations: no Python worker to scan them,
    # and the planner knows their (tiny) size.
    codes = code_table_sql()
    iucr = spark.sql(codes["iucr_codes"])
    fbi = spark.sql(codes["fbi_codes"])
    return CrimeTables(
        crimes=view("crimes"),
        iucr_codes=iucr,
        fbi_codes=fbi,
        victims=view("victims"),
        case_iucr=view("case_iucr"),
        properties=view("properties"),
        homicides=view("homicides"),
        offenders=view("offenders"),
        weapons=view("weapons"),
    )
