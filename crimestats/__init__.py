"""Crime reporting on Spark: index crime records / totals and the supplementary homicide report."""

from crimestats.functions.predicates import DistrictRange, Period, ReportingPeriods  # noqa: F401
from crimestats.plans.homicide import homicide_report, with_materialized_homicides  # noqa: F401
from crimestats.plans.index_crime import index_records, index_report, index_totals  # noqa: F401
from crimestats.session import recommended_conf  # noqa: F401
from crimestats.sources.layout import write_bucketed_tables  # noqa: F401
from crimestats.sources.tables import CrimeTables, read_catalog_tables, read_parquet_tables  # noqa: F401
