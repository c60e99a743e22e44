"""Supplementary homicide report rules and traps, inline rows."""

from __future__ import annotations

from conftest import ts
from pyspark.sql import functions as F

from crimestats.functions import codes as C
from crimestats.functions import recode as R
from crimestats.functions.predicates import Period
from crimestats.operators.relational import with_codes
from crimestats.plans import homicide as H

P = Period.calendar_year(2016)


def hom(i, rd, cls="M", *, injury="SHOT", active="Y", district="5", cleared="Y", cause="400", last="SMITH",
        first="ANN", age=30, sex="M", race="BLK", rel="FRIENDS", when="2016-06-01 10:00:00"):
    return {"ID": i, "RD_NO": rd, "HOMICIDE_NO": f"{cls}{i:06d}", "INJURY_DATE": ts(when), "ACTIVE_I": active,
            "CURR_DISTRICT": district, "CLEARED_I": cleared, "DEATH_CAUSE_CD": cause, "MOTIVE_DESCR": "X",
            "INJURY_DESCR": injury, "VICTIM_LAST_NME": last, "VICTIM_FIRST_NME": first, "VICTIM_AGE": age,
            "VICTIM_SEX": sex, "VICTIM_RACE": race, "VICTIM_REL_TO_OFFENDER": rel}


def off(i, hid, *, last="DOE", age=40, sex="F", race="WHI"):
    return {"ID": i, "HOM_HOMICIDE_ID": hid, "LAST_NME": last, "FIRST_NME": "F", "AGE": age, "SEX": sex, "RACE": race}


def weap(i, hid, wtype, name):
    return {"ID": i, "HOM_HOMICIDE_ID": hid, "WEAPON_TYPE": wtype, "WEAPON_NAME": name}


def report(t):
    return [r.asDict() for r in H.homicide_report(t, P).collect()]


def test_t9_weapon_null_code_sorts_last(make_tables):
    t = make_tables(homicides=[hom(1, "H1")], offenders=[off(10, 1)],
                    weapons=[weap(100, 1, "ALIEN", "RAY"), weap(101, 1, "VEHICLE", "CAR")])
    rows = report(t)
    assert [r["WEAP_CODE"] for r in rows] == ["90"]


def test_t18_strangulation_without_weapon_row_has_no_code(make_tables):
    t = make_tables(homicides=[hom(1, "H1", injury="STRANGULATION"), hom(2, "H2", injury="STRANGULATION")],
                    offenders=[off(10, 1), off(11, 2)], weapons=[weap(100, 2, "OTHER", "ROPE")])
    by_case = {r["CASE#_TYPE2"]: r["WEAP_CODE"] for r in report(t)}
    assert by_case == {"M000001": None, "M000002": "80"}


def test_t11_situation_counts(make_tables):
    homs = [hom(1, "HA"), hom(2, "HA"), hom(3, "HB"), hom(4, "HB"), hom(5, "HC")]
    offs = [off(10, 1), off(11, 1), off(12, 2), off(13, 3)]
    t = make_tables(homicides=homs, offenders=offs)
    sit = {r.RD_NO: r.SITCODE for r in H.situation_codes(H.party_counts(t, H.homicide_scope(t, P))).collect()}
    assert sit == {"HA": "E", "HB": None, "HC": None}


def test_t12_one_incident_several_situations(make_tables):
    homs = [hom(1, "HX", "M", cleared="N"), hom(2, "HX", "J", cleared="N")]
    t = make_tables(homicides=homs, offenders=[off(10, 1), off(11, 2)])
    rows = report(t)
    assert {(r["CASE#_TYPE2"], r["SIT_CODE"]) for r in rows} == {
        ("M000001", "F"), ("M000001", "D"), ("J000002", "F"), ("J000002", "D")}


def test_t13_circumstance_fan_out_includes_inactive(make_tables):
    homs = [hom(1, "HM", cause="400"), hom(2, "HM", cause="200", active="N")]
    t = make_tables(homicides=homs, offenders=[off(10, 1)])
    rows = report(t)
    assert sorted(r["CIRC_CODE"] for r in rows) == ["05", "17"]


def test_t14_t15_justified_roles(make_tables):
    homs = [hom(1, "H1", "J", last="POWELL", first="A", age=20, sex="F", race="API"),
            hom(2, "H2", "J", last=None, first="ANN", age=20, sex="F", race="API"),
            hom(3, "H3", "J", last=None, first=None, cause="200", age=20, sex="F", race="API")]
    offs = [off(10, 1, age=50, sex="M", race="BLK"), off(11, 2, age=50, sex="M", race="BLK"),
            off(12, 3, age=50, sex="M", race="BLK")]
    t = make_tables(homicides=homs, offenders=offs)
    rows = {r["CASE#_TYPE2"]: r for r in report(t)}
    police, citizen, unnamed = rows["J000001"], rows["J000002"], rows["J000003"]
    assert police["CIRC_CODE"] == "81" and police["VIC_AGE"] == "50" and police["OFF_AGE"] == "20"
    assert police["VIC_SEX"] == "M" and police["OFF_RACE"] == "A" and police["WEAP_CODE"] == "12"
    assert citizen["CIRC_CODE"] == "80" and citizen["VIC_AGE"] == "20" and citizen["OFF_AGE"] == "50"
    # No names: falls to the circumstance code, which is NULL here (no non-I/J homicide in RD) -> both
    # role groups show the victim.
    assert unnamed["CIRC_CODE"] is None and unnamed["VIC_AGE"] == "20" and unnamed["OFF_AGE"] == "20"


def test_police_weapon_override(make_tables):
    homs = [hom(1, "H1", "J", last="P.O. X", injury="SHOT"), hom(2, "H2", "J", last="P.O. X", injury="STABBED"),
            hom(3, "H3", "J", last="P.O. X", injury=None)]
    weaps = [weap(100, 1, "FIREARM", "RIFLE"), weap(101, 2, "STABBING/CUTTING", "KNIFE"),
             weap(102, 3, "FIREARM", "RIFLE")]
    t = make_tables(homicides=homs, offenders=[off(10, 1), off(11, 2), off(12, 3)], weapons=weaps)
    got = {r["CASE#_TYPE2"]: r["WEAP_CODE"] for r in report(t)}
    # NULL injury: no override arm matches and the weapon code is NULL too (NULL injury, T18 rule).
    assert got == {"J000001": "12", "J000002": " ", "J000003": None}


def test_suspects_collapse_to_one_row(make_tables):
    t = make_tables(homicides=[hom(1, "H1", cleared="N")], offenders=[off(10, 1), off(11, 1), off(12, 1)])
    rows = report(t)
    assert len(rows) == 1
    r = rows[0]
    assert r["SIT_CODE"] == "B" and r["OFF#"] == 1 and r["REL_CODE"] == "UN"
    assert (r["OFF_AGE"], r["OFF_SEX"], r["OFF_RACE"], r["OFF_ETH"]) == ("00", "U", "U", "U")


def test_t23_no_offender_blanks_offender(make_tables):
    t = make_tables(homicides=[hom(1, "H1", rel="FRIENDS")])
    rows = report(t)
    assert len(rows) == 1
    r = rows[0]
    assert r["SIT_CODE"] is None and r["OFF_AGE"] == "00" and r["REL_CODE"] == "FR" and r["OFF#"] == 1


def test_ranks(make_tables):
    homs = [hom(3, "HB"), hom(1, "HA"), hom(2, "HA")]
    offs = [off(12, 1), off(10, 1), off(11, 3)]
    t = make_tables(homicides=homs, offenders=offs)
    rows = sorted((r["CASE#_TYPE2"], r["V_COUNT"], r["VIC#"], r["OFF#"]) for r in report(t))
    assert rows == [("M000001", 1, 1, 1), ("M000001", 1, 1, 2), ("M000002", 2, 2, 1), ("M000003", 3, 1, 1)]


def test_t16_t17_recodes(spark):
    ages = [None, -1, 0, 1, 2, 9, 10, 98, 99, 100, 985, 990]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = df.select(R.victim_age_band("age").alias("v"), R.offender_age_band("age", "TRUE").alias("o")).collect()
    assert [r.v for r in got] == [None, None, None, " ", "2", "9", "10", "98", "99", "100", None, "99"]
    assert [r.o for r in got] == ["00", "00", "00", "1", "2", "9", "10", "98", "99", "100", "00", "99"]
    races = spark.createDataFrame([("WBH",), ("U",), (None,), ("ZZZ",)], "race string")
    got = races.select(R.victim_race("race").alias("vr"), R.victim_ethnicity("race").alias("ve"),
                       R.offender_race("race", "TRUE").alias("orc"),
                       R.offender_ethnicity("race", "TRUE").alias("oe")).collect()
    assert [tuple(r) for r in got] == [("B", "H", "W", "H"), (" ", " ", "U", "U"), (" ", " ", "U", "U"),
                                       (None, None, "U", "U")]


def test_relationship_codes(spark):
    df = spark.createDataFrame([("CHILD", "M"), ("CHILD", "X"), (None, "M"), ("MARTIAN", "F"),
                                ("MOTHER'S PARAMOUR", "F"), ("FATHER-IN-LAW", "M")], "rel string, sex string")
    coded = with_codes(df, "rel", R.relation_rows(), R.RELATION_FIELDS)
    got = coded.select(R.relationship_code("rel", "sex", None).alias("c")).collect()
    assert [r.c for r in got] == ["SO", None, "UN", None, "AQ", "IL"]
    # a table of fixed values: one hash probe a row, no chain of comparisons
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [rel" in plan and "MOTHER'S" not in plan.split("LocalTableScan")[0]


def test_every_relationship_equals_the_first_match_of_its_rules(spark):
    """Against the rules read one by one, for every text, sex and situation."""
    def first_match(rel, sex, sit):
        if sit in C.UNKNOWN_OFFENDER_SITUATIONS:
            return "UN"
        for value, of_sex, code in C.RELATION_BY_SEX:
            if rel == value and sex == of_sex:
                return code
        return next((code for values, code in C.RELATION_CODES if (rel is None if values is None else rel in values)), None)

    texts = [v for values, _ in C.RELATION_CODES for v in (values or [None])] + ["CHILD", "LIFE PARTNER", "child", "", "MARTIAN"]
    rows = [(r, s, t) for r in texts for s in ("M", "F", "X", "", None) for t in ("A", "B", "F", None)]
    coded = with_codes(spark.createDataFrame(rows, "rel string, sex string, sit string"), "rel", R.relation_rows(), R.RELATION_FIELDS)
    got = {(r.rel, r.sex, r.sit): r.c for r in coded.withColumn("c", R.relationship_code("rel", "sex", "sit")).collect()}
    assert got == {row: first_match(*row) for row in rows}


def test_circumstance_age_split_is_numeric(spark):
    df = spark.createDataFrame([("140", 17), ("140", 18), ("700", 5), ("700", None), ("999", 30)], "c string, a int")
    got = df.select(R.circumstance_code("c", "a").alias("x")).collect()
    assert [r.x for r in got] == ["47", "46", "47", None, None]


def test_off_rank_of_offenderless_row_sharing_a_homicide_number(make_tables):
    a, b = hom(1, "H1"), hom(2, "H1")
    b["HOMICIDE_NO"] = a["HOMICIDE_NO"]  # same homicide number, second row without offenders
    t = make_tables(homicides=[a, b], offenders=[off(10, 1), off(11, 1)])
    scope = H.homicide_scope(t, P)
    ranks = H.report_ranks(t, scope)
    got = {(r.HOMICIDE_NO, r.HOFFID): r.OFF_RANK for r in ranks["off_no"].collect()}
    assert got == {("M000001", 10): 1, ("M000001", 11): 2, ("M000001", None): 3}


def test_chunked_offenders_give_the_same_report(make_tables, monkeypatch):
    """A homicide with most offenders, one without any, two that share a number and an offender listed twice."""
    homs = [hom(1, "HA"), hom(2, "HA"), hom(3, "HB"), hom(4, "HB") | {"HOMICIDE_NO": "M000003"}, hom(5, None)]
    offs = [off(100 + i, 1, age=20 + i % 50) for i in range(40)] + [off(100, 1)]
    offs += [off(200, 3), off(201, 3), off(202, 3), off(300, 4), off(301, 5), off(None, 5, age=33)]
    t = make_tables(homicides=homs, offenders=offs, weapons=[weap(1, 1, "VEHICLE", "CAR")])

    def rows(**args):
        return sorted((tuple(r) for r in H.homicide_report(t, P, ordered=False, **args).collect()), key=repr)

    whole = rows()
    monkeypatch.setattr(H, "OFFENDERS_PER_CHUNK", 2)
    assert rows() == whole and rows(materialize=False) == whole
    assert len({r[15] for r in whole if r[3] == "M000001"}) == 40
    assert [r[15] for r in whole if r[3] == "M000002"] == [1]


def test_no_join_key_holds_more_than_a_chunk_of_offenders(make_tables, monkeypatch):
    """The last join pairs a hot homicide's offenders by chunk, in the plan and in its largest key."""
    monkeypatch.setattr(H, "OFFENDERS_PER_CHUNK", 10)
    t = make_tables(homicides=[hom(i, f"H{i}") for i in range(1, 9)],
                    offenders=[off(i, 1 if i % 3 else 1 + i % 8) for i in range(1, 301)])
    master = H.homicide_master(t, P, distinct=False)
    assert "CHUNK" in master._jdf.queryExecution().optimizedPlan().toString()
    sizes = master.groupBy("HOM_HOMICIDE_ID", "HOMICIDE_NO", F.expr("(OFFCNT - 1) DIV 10")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 10
    assert master.count() == 300
