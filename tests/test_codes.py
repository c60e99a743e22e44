"""The fixed code tables, pinned apart from the queries and their checks, which both read them."""

from __future__ import annotations

import hashlib

from crimestats.functions import codes

#: Digest of every constant's name and value; it changes only when a reporting code does.
PINNED = "bffb4edcb4a0f4dae392f83852b116d7668b1df984f346db8ae420fa44247cea"


def constants() -> list[tuple]:
    return sorted((k, v) for k, v in vars(codes).items() if k.isupper())


def test_code_tables_are_the_pinned_ones():
    assert hashlib.sha256(repr(constants()).encode()).hexdigest() == PINNED


def test_single_values():
    assert codes.VICTIM_COUNTED_CODES == ("02", "04A", "04B") and codes.INCIDENT_CODES == ("03", "07", "09")
    assert codes.VEHICLE_LOCATIONS == ("309", "262", "126", "259")
    assert codes.ARSON_IUCR == ("1010", "1020", "1025", "1090")
    assert dict(codes.VICTIM_RACE)["WBH"] == "B" and dict(codes.OFFENDER_RACE)["WBH"] == "W"
    assert (codes.AGE_SPLIT_MINOR, codes.AGE_SPLIT_ADULT, codes.AGE_SPLIT_AT) == ("47", "46", 17)
    assert codes.POLICE_NAME_PATTERNS == ("%#%", "%P.O.%", "%PO%")


def test_no_text_has_two_codes():
    for table in (codes.VICTIM_RACE, codes.VICTIM_ETHNICITY, codes.OFFENDER_RACE, codes.OFFENDER_ETHNICITY):
        texts = [t for t, _ in table]
        assert len(texts) == len(set(texts))
