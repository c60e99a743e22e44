"""Index crime rules and their traps, inline rows."""

from __future__ import annotations

import pytest
from conftest import ts
from pyspark.sql import functions as F

from crimestats.functions.predicates import DistrictRange, Period, numeric_between
from crimestats.operators.relational import not_in_subquery
from crimestats.plans import index_crime as I
from crimestats.sources.fixtures import FBI_ROWS, IUCR_ROWS

P = Period.calendar_year(2016)

IUCR = [{"CD": cd, "FBI_CD": fbi} for cd, fbi in IUCR_ROWS] + [{"CD": "0915", "FBI_CD": "07"}]
FBI = [{"CD": cd} for cd in FBI_ROWS]


def crime(i, iucr, *, status="010", rd="R", district="005", location="290", when="2016-06-01 12:00:00",
          month="06", year="2016"):
    return {"ID": i, "RD": None if rd is None else f"{rd}{i}", "CURR_IUCR": iucr, "DATEOCC": ts(when),
            "STATUS": status, "DISTRICT": district, "LOCATION": location, "MONTH": month, "YEAR": year}


def records(tables, method):
    return {tuple(r) for r in I.index_records(tables, P, method=method).collect()}


def both_methods(tables):
    u, s = records(tables, "union"), records(tables, "single_pass")
    assert u == s
    return u


def test_t1_period_end_is_inclusive_to_the_second(make_tables):
    t = make_tables(crimes=[crime(1, "0312", when="2016-12-31 23:59:59"),
                            crime(2, "0312", when="2017-01-01 00:00:00"),
                            crime(3, "0312", when="2016-01-01 00:00:00")],
                    iucr_codes=IUCR, fbi_codes=FBI)
    assert sorted(r.ID for r in I.case_base(t, P).collect()) == [1, 3]


def test_t2_district_text_parsed_as_number(spark, make_tables):
    districts = ["001", "25", "26", "X1", None, " 05 "]
    t = make_tables(crimes=[crime(i, "0312", district=d) for i, d in enumerate(districts)],
                    iucr_codes=IUCR, fbi_codes=FBI)
    assert sorted(r.ID for r in I.case_base(t, P).collect()) == [0, 1, 5]
    strict = t.crimes.where(numeric_between(F.col("DISTRICT"), 1, 25, strict=True))
    with pytest.raises(Exception):
        strict.collect()


def test_t3_null_status_prefix_drops(make_tables):
    t = make_tables(crimes=[crime(1, "0312", status=None), crime(2, "0312", status="7A"),
                            crime(3, "0312", status="0")], iucr_codes=IUCR, fbi_codes=FBI)
    assert [r.ID for r in I.case_base(t, P).collect()] == [3]


def test_t4_burglary_location(make_tables):
    t = make_tables(crimes=[crime(1, "0610", location=None), crime(2, "0610", location="309"),
                            crime(3, "0610", location="290")], iucr_codes=IUCR, fbi_codes=FBI)
    got = both_methods(t)
    assert {(r[0], r[3]) for r in got} == {(2, "06"), (3, "05")}


def test_t5_not_in_with_null_in_subquery(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    with_null = spark.createDataFrame([(1,), (None,)], "k long")
    no_null = spark.createDataFrame([(1,)], "k long")
    empty = spark.createDataFrame([], "k long")
    assert not_in_subquery(left, with_null, "k", "k").count() == 0
    assert [r.k for r in not_in_subquery(left, no_null, "k", "k").collect()] == [2]
    assert sorted(not_in_subquery(left, empty, "k", "k").collect(), key=str) == sorted(left.collect(), key=str)


def test_i3_requires_known_fbi_code(make_tables):
    t = make_tables(crimes=[crime(1, "0312"), crime(2, "0910")], iucr_codes=IUCR,
                    fbi_codes=[{"CD": c} for c in FBI_ROWS if c != "03"])
    assert {(r[0], r[3]) for r in both_methods(t)} == {(2, "07")}


def test_t6_t7_victim_code_and_dedupe(make_tables):
    t = make_tables(crimes=[crime(1, "0261"), crime(2, "0487")], iucr_codes=IUCR, fbi_codes=FBI,
                    victims=[{"CASE_ID": 1, "NO_ID": 1, "VFBI_CD": "04B"}, {"CASE_ID": 1, "NO_ID": 1, "VFBI_CD": "04B"},
                             {"CASE_ID": 1, "NO_ID": 2, "VFBI_CD": "08A"}, {"CASE_ID": 2, "NO_ID": 1, "VFBI_CD": "02"}])
    got = both_methods(t)
    assert got == {(1, "R1", 1, "04B", "06", "2016")}


def test_mvt_override_and_larceny_remainder_are_disjoint(make_tables):
    crimes = [crime(1, "0820"), crime(2, "0820"), crime(3, "0840"), crime(4, "0610", location="309")]
    codes = [{"CASE_ID": 1, "IUCR_CODE_CD": "0915"}, {"CASE_ID": 3, "IUCR_CODE_CD": "0917"},
             {"CASE_ID": 4, "IUCR_CODE_CD": "0938"}]
    t = make_tables(crimes=crimes, iucr_codes=IUCR, fbi_codes=FBI, case_iucr=codes)
    got = {(r[0], r[3]) for r in both_methods(t)}
    assert got == {(1, "07"), (2, "06"), (4, "07")}  # 0840 is in neither


def test_records_are_a_set_for_repeated_rows_and_cases_without_an_id(make_tables):
    """Repeated crimes, victims and homicides; one id under two codes, whose rules give the same record; null ids."""
    def nameless(iucr, rd):
        return {**crime(0, iucr), "ID": None, "RD": rd}

    hom = {"ID": 9, "RD_NO": "H9", "HOMICIDE_NO": "M9", "INJURY_DATE": ts("2016-03-04 05:06:07"), "ACTIVE_I": "Y", "CURR_DISTRICT": "3"}
    base = dict(iucr_codes=IUCR, fbi_codes=FBI, homicides=[hom, hom],
                victims=[{"CASE_ID": 5, "NO_ID": 1, "VFBI_CD": "02"}] * 3 + [{"CASE_ID": None, "NO_ID": 1, "VFBI_CD": "02"}])
    crimes = [crime(1, "0910"), crime(1, "0820"), crime(1, "0820"), crime(2, "1010"), crime(2, "0312"), crime(5, "0261"), crime(5, "0261"),
              nameless("0312", "N1"), nameless("0312", "N1"), nameless("0820", "N2"), nameless("0261", "N3")]
    codes = [{"CASE_ID": 1, "IUCR_CODE_CD": "0915"}, {"CASE_ID": 1, "IUCR_CODE_CD": "0917"}, {"CASE_ID": 2, "IUCR_CODE_CD": "1090"},
             {"CASE_ID": None, "IUCR_CODE_CD": "0915"}]
    fixed = {(9, "H9", 1, "01A", "03", "2016"), (5, "R5", 1, "02", "06", "2016"), (None, "N1", 1, "03", "06", "2016"),
             (2, "R2", 1, "03", "06", "2016"), (2, "R2", 1, "09", "06", "2016")}
    for case_iucr, more in ((codes, {(1, "R1", 1, "07", "06", "2016")}),
                            (codes[2:], {(1, "R1", 1, "07", "06", "2016"), (1, "R1", 1, "06", "06", "2016"), (None, "N2", 1, "06", "06", "2016")})):
        t = make_tables(crimes=crimes, case_iucr=case_iucr, **base)
        assert both_methods(t) == fixed | more
        for method in ("union", "single_pass"):
            for staged in (True, False):
                rows = [tuple(r) for r in I.index_records(t, P, method=method, materialize=staged).collect()]
                assert sorted(rows, key=repr) == sorted(fixed | more, key=repr)


def test_arson_additional_records(make_tables):
    crimes = [crime(1, "0312"), crime(2, "1310"), crime(3, "1010"), crime(4, "1310")]
    codes = [{"CASE_ID": 1, "IUCR_CODE_CD": "1090"}, {"CASE_ID": 1, "IUCR_CODE_CD": "1310"},
             {"CASE_ID": 2, "IUCR_CODE_CD": "1320"}, {"CASE_ID": 3, "IUCR_CODE_CD": "1310"},
             {"CASE_ID": 4, "IUCR_CODE_CD": "1310"}]
    props = [{"CASE_ID": 1, "BURNED_I": "Y"}, {"CASE_ID": 2, "BURNED_I": "Y"}, {"CASE_ID": 3, "BURNED_I": "Y"},
             {"CASE_ID": 4, "BURNED_I": None}]
    t = make_tables(crimes=crimes, iucr_codes=IUCR, fbi_codes=FBI, case_iucr=codes, properties=props)
    got = {(r[0], r[3]) for r in both_methods(t)}
    # case 1: robbery + masked arson (+ burned damage, same record); 2: burned damage; 3: arson case itself
    assert got == {(1, "03"), (1, "09"), (2, "09"), (3, "09")}


def test_homicide_branch_excludes_involuntary_and_justified(make_tables):
    hom = [{"ID": i, "RD_NO": f"H{i}", "HOMICIDE_NO": None if c is None else f"{c}{i}", "INJURY_DATE": ts("2016-03-04 05:06:07"),
            "ACTIVE_I": a, "CURR_DISTRICT": "3"} for i, c, a in [(1, "M", "Y"), (2, "I", "Y"), (3, "J", "Y"),
                                                                 (4, "M", "N"), (5, None, "Y")]]
    t = make_tables(homicides=hom, iucr_codes=IUCR, fbi_codes=FBI)
    assert {tuple(r) for r in I.homicide_records(t, P).collect()} == {(1, "H1", 1, "01A", "03", "2016")}


def test_t8_crosstab_zero_not_null(make_tables):
    t = make_tables(crimes=[crime(1, "0261")], iucr_codes=IUCR, fbi_codes=FBI,
                    victims=[{"CASE_ID": 1, "NO_ID": 1, "VFBI_CD": "02"}])
    rows = I.index_report(t, P).collect()
    assert len(rows) == 1
    d = rows[0].asDict()
    assert d["02"] == 1 and all(d[c] == 0 for c in ["01A", "03", "04A", "04B", "05", "06", "07", "09"])


def test_district_and_period_parameters(make_tables):
    t = make_tables(crimes=[crime(1, "0312", district="030"), crime(2, "0312", when="2015-05-05 00:00:00",
                                                                    month="05", year="2015")],
                    iucr_codes=IUCR, fbi_codes=FBI)
    got = I.index_records(t, Period.calendar_years(2015, 2016), DistrictRange(1, 40)).collect()
    assert sorted(r.ID for r in got) == [1, 2]


def test_t25_crime_month_year_are_the_stored_columns(make_tables):
    t = make_tables(crimes=[crime(1, "0312", when="2016-06-30 23:00:00", month="07", year="2016")],
                    iucr_codes=IUCR, fbi_codes=FBI)
    assert [(r.MONTH, r.YEAR) for r in I.index_records(t, P).collect()] == [("07", "2016")]


def test_ingest_cleaning_blank_padding_and_empty_text(spark, make_tables):
    from crimestats.sources.tables import normalize_source_text

    t = make_tables(crimes=[crime(1, "0312", rd=""), crime(2, "0312  ", location="290 ")], iucr_codes=IUCR,
                    fbi_codes=FBI)
    t = t.map(lambda name, df: df.withColumn("RD", F.when(F.col("ID") == 1, F.lit("")).otherwise(F.col("RD")))
              if name == "crimes" else df)
    cleaned = normalize_source_text(t)
    assert sorted(r.ID for r in I.case_base(cleaned, P).collect()) == [2]   # '' RD is NULL
    assert sorted(r.ID for r in I.case_base(t, P).collect()) == [1]         # padded code does not match
