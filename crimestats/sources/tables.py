"""Input relations of the reports and how to read them.

``CrimeTables`` bundles the nine relations.  They can come from Parquet folders
(one per relation), from catalog tables, or from any DataFrame with the columns
of ``crimestats.schemas.INPUT_SCHEMAS``.  Reading with an explicit schema keeps
Parquet column pruning and filter pushdown: every report selects a handful of
columns and filters on period / flags first, and those reach the scan.

For very large ``crimes`` / ``homicides`` tables the recommended layout is
Parquet partitioned by the occurrence or injury date (``sources.layout``): the
folders' columns are found on reading, and the reports' period predicates prune
whole folders by them.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crimestats.schemas import INPUT_SCHEMAS


@dataclass(frozen=True)
class CrimeTables:
    crimes: DataFrame
    iucr_codes: DataFrame
    fbi_codes: DataFrame
    victims: DataFrame
    case_iucr: DataFrame
    properties: DataFrame
    homicides: DataFrame
    offenders: DataFrame
    weapons: DataFrame

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]

    def map(self, fn) -> CrimeTables:
        return replace(self, **{name: fn(name, getattr(self, name)) for name in self.names()})


def read_parquet_tables(spark: SparkSession, root: str, layout: dict[str, str] | None = None) -> CrimeTables:
    """Read ``root/<name>`` (or ``layout[name]``) with the declared schemas."""
    layout = layout or {}

    def read(name: str) -> DataFrame:
        path = layout.get(name, f"{root.rstrip('/')}/{name}")
        return spark.read.schema(INPUT_SCHEMAS[name]).parquet(path)

    return CrimeTables(**{name: read(name) for name in INPUT_SCHEMAS})


def read_catalog_tables(spark: SparkSession, names: dict[str, str]) -> CrimeTables:
    """Bind catalog tables, e.g. ``{"crimes": "dwh.crimes_allv", ...}``."""
    return CrimeTables(**{name: spark.table(names[name]) for name in INPUT_SCHEMAS})


def _clean_text(col: Column) -> Column:
    # CHAR columns arrive blank-padded, and the source database stores '' as NULL.
    trimmed = F.rtrim(col)
    return F.when(trimmed == "", F.lit(None).cast("string")).otherwise(trimmed)


def normalize_source_text(tables: CrimeTables) -> CrimeTables:
    """Optional ingest step for extracts of a blank-padding, ''-is-NULL database.

    Applies ``rtrim`` and ``'' -> NULL`` to every string column.  Only for such
    sources: the rewritten columns no longer push filters into the Parquet scan,
    so land the cleaned tables once rather than cleaning per report.
    """

    def clean(_name: str, df: DataFrame) -> DataFrame:
        return df.select(*(
            _clean_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ))

    return tables.map(clean)
