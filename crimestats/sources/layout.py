"""Co-located storage layout for the case-keyed and homicide-keyed joins.

The index report joins one period of ``crimes`` with three case-keyed tables
(``victims``, ``case_iucr``, ``properties``) that carry no date and are read
whole; the homicide report joins ``homicides`` with ``offenders`` and
``weapons``.  Bucketing each group by its join key with one bucket count lets
Spark plan those joins (and the per-case aggregates) without shuffling the
large sides: the sort-merge joins read matching buckets directly.

Each table is hash-repartitioned by its bucket column before the write, so a
task writes one file per bucket (``buckets`` files per table, not
tasks x buckets).  Choose ``buckets`` so one bucket of the largest table is a
comfortable task input (a few hundred MB): e.g. 8192 for tens of TB.

A report needs one period of ``crimes`` and ``homicides``.  Both layouts folder
these by a column derived from the date that the period is tested on (not the
stored YEAR, which need not agree with it): by month in plain Parquet, by year
in the bucketed tables, whose files are buckets x folders.  The reports add the
matching predicate (``predicates.period_of``), so a scan lists and reads the
period's folders only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crimestats.sources.tables import CrimeTables, read_catalog_tables, read_parquet_tables

BUCKET_KEYS = {
    "crimes": "ID",
    "victims": "CASE_ID",
    "case_iucr": "CASE_ID",
    "properties": "CASE_ID",
    "homicides": "ID",
    "offenders": "HOM_HOMICIDE_ID",
    "weapons": "HOM_HOMICIDE_ID",
}


#: Tables that a report reads one period of, and the date that it is tested on.
PERIOD_DATES = {"crimes": "DATEOCC", "homicides": "INJURY_DATE"}


def with_folder(name: str, df: DataFrame, by: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its derived partition column, and the partition columns; ``by``: year or month.  A null date has the null folder."""
    if name not in PERIOD_DATES:
        return df, []
    date = PERIOD_DATES[name]
    column = f"{date}_{by.upper()}"
    folder = F.year(date) if by == "year" else F.year(date) * 100 + F.month(date)
    return df.withColumn(column, folder), [column]


def write_dated_tables(tables: CrimeTables, root: str, mode: str = "overwrite") -> CrimeTables:
    """Write the nine relations as Parquet below ``root``, ``crimes`` and
    ``homicides`` in monthly folders; return them read back.

    The rows are shuffled by ranges of the date, so a month is a few tasks'
    files of few months each, and a month with a third of all rows is split."""
    for name in tables.names():
        df, folders = with_folder(name, getattr(tables, name), "month")
        if folders:
            df = df.repartitionByRange(PERIOD_DATES[name], "ID")
        df.write.mode(mode).partitionBy(*folders).parquet(f"{root.rstrip('/')}/{name}")
    return read_parquet_tables(tables.crimes.sparkSession, root)


def write_bucketed_tables(tables: CrimeTables, database: str, buckets: int, mode: str = "overwrite") -> CrimeTables:
    """Write the nine relations as Parquet catalog tables in ``database``,
    bucketed (and sorted) by their join keys, ``crimes`` and ``homicides`` in
    yearly folders besides; return them read back."""
    spark = tables.crimes.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in tables.names():
        df, folders = with_folder(name, getattr(tables, name), "year")
        key = BUCKET_KEYS.get(name)
        writer = (df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key)
                  if key else df.write)
        writer.partitionBy(*folders).mode(mode).format("parquet").saveAsTable(f"`{database}`.`{name}`")
    return read_catalog_tables(spark, {name: f"`{database}`.`{name}`" for name in tables.names()})
