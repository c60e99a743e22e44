"""Reporting code tables.

FIXED VALUES: every literal below must equal the reporting rules the reference
implements (UCR / supplementary homicide codes); they are stated once, in the
order the rules apply them.  Rules are first-match: earlier entries win.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Index crime (monthly return) ------------------------------------------------
EXCLUDED_STATUS_PREFIXES = ("2", "7")
VICTIM_COUNTED_CODES = ("02", "04A", "04B")          # reported per victim
VICTIM_COUNT_EXCLUDED_IUCR = ("0487",)
INCIDENT_CODES = ("03", "07", "09")                   # robbery, MVT, arson: per incident
BURGLARY_CODE = "05"
LARCENY_CODE = "06"
MVT_CODE = "07"
ARSON_CODE = "09"
HOMICIDE_CODE = "01A"
VEHICLE_LOCATIONS = ("309", "262", "126", "259")     # burglary from a vehicle -> larceny
MVT_IUCR = ("0910", "0915", "0917", "0918", "0920", "0925", "0927", "0928", "0930", "0935", "0937", "0938")
LARCENY_EXCLUDED_IUCR = ("0840", "0841", "0842", "0843")
ARSON_IUCR = ("1010", "1020", "1025", "1090")
ARSON_MASKING_CODES = ("01A", "02", "03", "04A", "04B", "05", "06", "07")
CRIMINAL_DAMAGE_IUCR = ("1310", "1320")
HOMICIDE_EXCLUDED_CLASSES = ("I", "J")               # involuntary, justified

# Supplementary homicide report -----------------------------------------------
INVOLUNTARY_CLASS = "I"
JUSTIFIED_CLASS = "J"
NON_WEAPON_INJURIES = ("STRANGULATION", "ASPHYXIATION")
POLICE_NAME_PATTERNS = ("%#%", "%P.O.%", "%PO%")
POLICE_CIRCUMSTANCE = "81"
CITIZEN_CIRCUMSTANCE = "80"
UNKNOWN_OFFENDER_SITUATIONS = ("B", "F")

# Weapon hierarchy: (column, value, code) where column is "name", "type",
# ("type+name"), ("type+injury") or "injury"; first match wins.  Every arm
# except the two injury arms also requires the injury not to be one of
# NON_WEAPON_INJURIES.
WEAPON_RULES = (
    ("name", "HANDGUN", "12"),
    ("name", "RIFLE", "13"),
    ("name", "SHOTGUN", "14"),
    ("type+name", ("FIREARM", "OTHER"), "15"),
    ("type", "STABBING/CUTTING", "20"),
    ("type+injury", ("UNKNOWN", "STABBED"), "20"),
    ("type", "BLUDGEON/CLUB", "30"),
    ("type", "HANDS/FEET", "40"),
    ("type", "POISON", "50"),
    ("type", "BURN", "65"),
    ("type", "DRUG", "70"),
    ("name", "WATER (DROWNING)", "75"),
    ("injury", "STRANGULATION", "80"),
    ("injury", "ASPHYXIATION", "85"),
    ("type", "VEHICLE", "90"),
    ("type", "LIGATURE", "90"),
    ("type", "OTHER", "90"),
    ("type", "UNKNOWN", "90"),
)

# Circumstance code from the death cause (motive) code; 140 and 700 split on
# victim age (numeric comparison): older than 17 -> 46, younger than 18 -> 47.
CIRCUMSTANCE_RULES = (
    (("400", "405"), "17"),
    (("840", "841"), "18"),
    (("105",), "19"),
    (("500", "925", "935"), "26"),
    (("155",), "40"),
    (("120",), "44"),
    (("100", "110", "115", "135", "160"), "45"),
    (("140", "700"), "AGE_SPLIT"),
    (("130", "150", "915", "920", "930", "940", "945", "950", "951", "955", "960", "965"), "60"),
    (("600",), "99"),
    (("300", "305"), "03"),
    (("200",), "05"),
    (("145", "905"), "06"),
    (("900",), "09"),
)
AGE_SPLIT_ADULT = "46"
AGE_SPLIT_MINOR = "47"
AGE_SPLIT_AT = 17

# Victim race / ethnicity; NULL and 'U' -> ' ', anything else -> NULL.
VICTIM_RACE = (("API", "A"), ("BLK", "B"), ("WBH", "B"), ("I", "I"), ("WHI", "W"), ("WWH", "W"))
VICTIM_ETHNICITY = (("WBH", "H"), ("WWH", "H"), ("API", "N"), ("BLK", "N"), ("I", "N"), ("WHI", "N"))
VICTIM_UNKNOWN_RACE = ("U",)
# Offender race / ethnicity when shown; anything else -> 'U'.
OFFENDER_RACE = (("API", "A"), ("BLK", "B"), ("I", "I"), ("WHI", "W"), ("WBH", "W"), ("WWH", "W"))
OFFENDER_ETHNICITY = (("WBH", "H"), ("WWH", "H"), ("API", "N"), ("BLK", "N"), ("I", "N"), ("WHI", "N"))

# Relationship of victim to offender.  Sex-dependent entries first.
RELATION_BY_SEX = (
    ("CHILD", "M", "SO"),
    ("CHILD", "F", "DA"),
    ("LIFE PARTNER", "M", "CH"),
    ("LIFE PARTNER", "F", "CW"),
)
RELATION_CODES = (
    (("BUSINESS PARTNER", "CO-WORKER", "DOCTOR", "EX-ROOMMATES", "LANDLADY", "LANDLORD", "MOTHER'S PARAMOUR",
      "PATIENT", "SOME ACQUAINTANCE", "TENANT"), "AQ"),
    (("BOYFRIEND", "EX-BOYFRIEND"), "BF"),
    (("BROTHER", "HALF-BROTHER"), "BR"),
    (("HUSBAND COMMON LAW",), "CH"),
    (("WIFE COMMON LAW",), "CW"),
    (("DAUGHTER",), "DA"),
    (("EMPLOYEE",), "EE"),
    (("EMPLOYER",), "ER"),
    (("FATHER",), "FA"),
    (("FRIENDS",), "FR"),
    (("GIRLFRIEND", "EX-GIRLFRIEND"), "GF"),
    (("HUSBAND",), "HU"),
    (("BROTHER IN LAW", "FATHER-IN-LAW", "MOTHER IN LAW", "SISTER IN LAW", "SON IN LAW"), "IL"),
    (("MOTHER",), "MO"),
    (("NEIGHBOR",), "NE"),
    (("AUNT", "COUSIN", "FOSTER BROTHER", "FOSTER DAUGHTER", "FOSTER MOTHER", "FOSTER SISTER", "FOSTER SON",
      "GRANDDAUGHTER", "GRANDFATHER", "GRANDMOTHER", "GRANDSON", "NEPHEW", "NIECE", "STEPBROTHER", "UNCLE",
      "WARD"), "OF"),
    (("PARAMOUR'S CHILD", "ROOMER", "ROOMMATES"), "OK"),
    (("STEPDAUGHTER",), "SD"),
    (("STEPFATHER",), "SF"),
    (("HALF-SISTER", "SISTER"), "SI"),
    (("STEPMOTHER",), "SM"),
    (("SON",), "SO"),
    (("STEPSON",), "SS"),
    (("CUSTOMER", "JANITOR", "NONE", "PROPRIETOR"), "ST"),
    (("NOT ESTABLISHED",), "UN"),
    (None, "UN"),                                     # relationship not recorded
    (("WIFE",), "WI"),
    (("EX-HUSBAND",), "XH"),
    (("EX-WIFE",), "XW"),
)
UNKNOWN_RELATION = "UN"
# ------------------------------------------------------------ end fixed values
