"""Period lists, session time zones and cases without an id."""

from __future__ import annotations

import pytest
from conftest import ts
from test_homicide import hom, off, weap
from test_index_crime import FBI, IUCR, crime, records

from crimestats.functions.predicates import Period, ReportingPeriods
from crimestats.plans import homicide as H
from crimestats.plans import index_crime as I

P = Period.calendar_year(2016)


@pytest.mark.parametrize("periods", [
    (),
    (("a", P), ("a", Period.calendar_year(2017))),
])
def test_empty_and_equally_named_periods_are_refused(periods):
    with pytest.raises(ValueError):
        ReportingPeriods(periods)


def test_columns_do_not_depend_on_the_length_of_the_list(make_tables):
    t = make_tables(homicides=[hom(1, "H1")], offenders=[off(10, 1)], weapons=[weap(100, 1, "OTHER", "ROPE")])
    one, two = ReportingPeriods((("2016", P),)), ReportingPeriods.calendar_years(2016, 2017)
    assert H.homicide_report(t, one).columns == H.homicide_report(t, two).columns
    assert "REPORT_PERIOD" in H.homicide_report(t, one).columns
    assert "REPORT_PERIOD" not in H.homicide_report(t, P).columns


@pytest.mark.parametrize("zone", ["UTC", "America/Denver"])
def test_date_text_does_not_move_with_the_session_zone(spark, make_tables, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = make_tables(homicides=[hom(1, "H1", when="2016-03-13 02:30:00")])  # inside Denver's spring gap
        row = H.homicide_master(t, P).collect()[0]
        assert (row.MNTH, row.YR, row.TIMEMIL) == ("03", "2016", "0230")
        assert [(r.MONTH, r.YEAR) for r in I.homicide_records(t, P).collect()] == [("03", "2016")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("overridden", [False, True])
def test_case_without_id_follows_not_in_in_both_methods(make_tables, overridden):
    nameless = crime(0, "0820", rd="N") | {"ID": None}
    cases = [nameless, crime(1, "0820")]
    t = make_tables(crimes=cases, iucr_codes=IUCR, fbi_codes=FBI,
                    case_iucr=[{"CASE_ID": 1, "IUCR_CODE_CD": "0915"}] if overridden else [])
    union, single = records(t, "union"), records(t, "single_pass")
    assert union == single
    assert any(r[0] is None for r in union) is (not overridden)


def test_weapons_reduced_before_the_join_give_the_same_weapon(make_tables):
    t = make_tables(homicides=[hom(1, "H1"), hom(2, "H2")],
                    weapons=[weap(i, 1, "OTHER", "ROPE") for i in range(200, 260)] + [weap(300, 1, "FIREARM", "HANDGUN"), weap(7, 2, "ALIEN", "RAY")])
    scope = H.homicide_scope(t, P)
    assert sorted(map(tuple, H.homicide_weapon(t, scope).collect())) == sorted(map(tuple, H.lethal_weapon(H.weapon_codes(t, scope)).collect()))


def test_overlapping_periods_equal_separate_reports(make_tables):
    """Half-years, the year, one second and a period without rows in one job; ranks and counts are each period's own."""
    cut = lambda a, b: Period(ts(a), ts(b))
    periods = (("year", P), ("h1", cut("2016-01-01", "2016-07-01")), ("h2", cut("2016-07-01", "2017-01-01")), ("empty", cut("2019-01-01", "2019-02-01")),
               ("second", cut("2016-06-30 23:59:59", "2016-07-01")), ("again", P))
    when = ["2016-01-01 00:00:00", "2016-06-30 23:59:59", "2016-07-01 00:00:00", "2016-12-31 23:59:59", "2017-01-01 00:00:00"]
    homs = [hom(i, f"H{i % 2}", when=w) for i, w in enumerate(when, 1)] + [hom(9, "H1") | {"INJURY_DATE": None}]
    t = make_tables(homicides=homs, offenders=[off(10 + i, 1 + i % 6) for i in range(12)], weapons=[weap(100, 2, "FIREARM", "HANDGUN")])
    want = [(name, *r) for name, p in periods for r in H.homicide_report(t, p, ordered=False).collect()]
    got = H.homicide_report(t, ReportingPeriods(periods), ordered=False).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len({r[0] for r in want}) == 5
