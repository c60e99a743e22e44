"""Input and output schemas of the reports (only the columns the reports read)."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()

INPUT_SCHEMAS: dict[str, T.StructType] = {
    # MONTH / YEAR are stored text ('01'..'12', '2016'); they are reported as is.
    "crimes": _struct(("ID", L), ("RD", S), ("CURR_IUCR", S), ("DATEOCC", TS), ("STATUS", S),
                      ("DISTRICT", S), ("LOCATION", S), ("MONTH", S), ("YEAR", S)),
    "iucr_codes": _struct(("CD", S), ("FBI_CD", S)),
    "fbi_codes": _struct(("CD", S)),
    "victims": _struct(("CASE_ID", L), ("NO_ID", I), ("VFBI_CD", S)),
    "case_iucr": _struct(("CASE_ID", L), ("IUCR_CODE_CD", S)),
    "properties": _struct(("CASE_ID", L), ("BURNED_I", S)),
    "homicides": _struct(("ID", L), ("RD_NO", S), ("HOMICIDE_NO", S), ("INJURY_DATE", TS), ("ACTIVE_I", S),
                         ("CURR_DISTRICT", S), ("CLEARED_I", S), ("DEATH_CAUSE_CD", S), ("MOTIVE_DESCR", S),
                         ("INJURY_DESCR", S), ("VICTIM_LAST_NME", S), ("VICTIM_FIRST_NME", S), ("VICTIM_AGE", I),
                         ("VICTIM_SEX", S), ("VICTIM_RACE", S), ("VICTIM_REL_TO_OFFENDER", S)),
    "offenders": _struct(("ID", L), ("HOM_HOMICIDE_ID", L), ("LAST_NME", S), ("FIRST_NME", S), ("AGE", I),
                         ("SEX", S), ("RACE", S)),
    "weapons": _struct(("ID", L), ("HOM_HOMICIDE_ID", L), ("WEAPON_TYPE", S), ("WEAPON_NAME", S)),
}

# Fixed output column names of the reports.
INDEX_CODES = ("01A", "02", "03", "04A", "04B", "05", "06", "07", "09")
INDEX_RECORD = _struct(("ID", L), ("RD", S), ("NO_ID", I), ("FBI_CD", S), ("MONTH", S), ("YEAR", S))
INDEX_TOTALS = _struct(("YEAR", S), ("MONTH", S), *((code, L) for code in INDEX_CODES))
SHR_COLUMNS = (
    "MONTH", "YEAR", "CASE#_TYPE1", "CASE#_TYPE2", "V_COUNT", "HOM_TYPE", "SIT_CODE", "CIRC_CODE", "CIRC_SUBCODE",
    "WEAP_CODE", "VIC#", "VIC_AGE", "VIC_SEX", "VIC_RACE", "VIC_ETH", "OFF#", "OFF_AGE", "OFF_SEX", "OFF_RACE",
    "OFF_ETH", "REL_CODE",
)
SHR_ROW = _struct(*((c, L if c in ("V_COUNT", "VIC#", "OFF#") else S) for c in SHR_COLUMNS))
