"""Randomised invariants: the single-pass record set equals
the rule-by-rule union on messy inputs, totals add up, override and remainder
are disjoint."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crimestats.functions.predicates import Period
from crimestats.plans import index_crime as I
from crimestats.schemas import INDEX_CODES
from crimestats.sources.fixtures import FBI_ROWS, IUCR_ROWS

P = Period.calendar_year(2016)
CODES = [cd for cd, _ in IUCR_ROWS] + ["0915", "1020", "0841", "9999"]
CASE_CODES = CODES + ["0917", "1090", "1025", "0930"]


def _random_tables(make_tables, seed: int):
    rnd = random.Random(seed)
    crimes = []
    for i in range(400):
        cid = rnd.randint(1, 300)  # duplicate crime rows share an id
        when = dt.datetime(2016, 1, 1) + dt.timedelta(seconds=rnd.randint(-86400 * 20, 86400 * 380))
        crimes.append({"ID": cid, "RD": rnd.choice([None, f"R{cid}"]), "CURR_IUCR": rnd.choice(CODES),
                       "DATEOCC": when, "STATUS": rnd.choice([None, "010", "200", "700", "0"]),
                       "DISTRICT": rnd.choice(["001", "017", "26", "X", None]),
                       "LOCATION": rnd.choice([None, "309", "290", "126"]), "MONTH": f"{when.month:02d}",
                       "YEAR": str(when.year)})
    hot = 7  # one case carries a third of the case-keyed rows
    case_iucr = [{"CASE_ID": hot if rnd.random() < 0.34 else rnd.randint(1, 300), "IUCR_CODE_CD": rnd.choice(CASE_CODES)}
                 for _ in range(900)]
    victims = [{"CASE_ID": hot if rnd.random() < 0.34 else rnd.randint(1, 300), "NO_ID": rnd.randint(1, 4),
                "VFBI_CD": rnd.choice(["02", "04A", "04B", "08A", None])} for _ in range(900)]
    props = [{"CASE_ID": rnd.randint(1, 300), "BURNED_I": rnd.choice(["Y", "N", None])} for _ in range(300)]
    iucr = [{"CD": cd, "FBI_CD": fbi} for cd, fbi in IUCR_ROWS] + [
        {"CD": "0915", "FBI_CD": "07"}, {"CD": "1020", "FBI_CD": "09"}, {"CD": "0841", "FBI_CD": "06"}]
    fbi = [{"CD": c} for c in FBI_ROWS if c != "05" or seed % 2]
    return make_tables(crimes=crimes, victims=victims, case_iucr=case_iucr, properties=props, iucr_codes=iucr,
                       fbi_codes=fbi)


@pytest.mark.parametrize("seed", [3, 4])
def test_single_pass_equals_union_on_random_tables(make_tables, seed):
    t = _random_tables(make_tables, seed)
    u = I.index_records(t, P, method="union")
    s = I.index_records(t, P, method="single_pass")
    assert u.count() > 0
    assert u.exceptAll(s).count() == 0 and s.exceptAll(u).count() == 0
    # records are a set, every code is an index code, totals add up
    assert s.count() == s.distinct().count()
    codes = {r.FBI_CD for r in s.select("FBI_CD").distinct().collect()}
    assert codes <= set(INDEX_CODES)
    totals = I.index_totals(s).collect()
    assert sum(sum(r[c] for c in INDEX_CODES) for r in totals) == s.count()
    cb = I.case_base(t, P)
    over = {r.ID for r in I.mvt_override_records(cb, t).collect()}
    rest = {r.ID for r in I.larceny_remainder_records(cb, t).collect()}
    population = {r.ID for r in cb.where(I.is_larceny_population()).collect()}
    assert not over & rest and over | rest == population


def test_at_most_one_weapon_per_homicide(spark, make_tables):
    rnd = random.Random(9)
    types = ["FIREARM", "STABBING/CUTTING", "UNKNOWN", "OTHER", "ALIEN", None]
    names = ["HANDGUN", "RIFLE", "OTHER", "KNIFE", None]
    weapons = [{"ID": i, "HOM_HOMICIDE_ID": 1 if rnd.random() < 0.34 else rnd.randint(1, 40),
                "WEAPON_TYPE": rnd.choice(types), "WEAPON_NAME": rnd.choice(names)} for i in range(300)]
    homs = [{"ID": h, "RD_NO": f"H{h}", "HOMICIDE_NO": f"M{h:06d}", "INJURY_DATE": dt.datetime(2016, 5, 5),
             "ACTIVE_I": "Y", "CURR_DISTRICT": "3", "INJURY_DESCR": rnd.choice(["SHOT", "STABBED", None])}
            for h in range(1, 41)]
    t = make_tables(homicides=homs, weapons=weapons)
    from crimestats.plans import homicide as H

    top = H.lethal_weapon(H.weapon_codes(t, H.homicide_scope(t, P)))
    assert top.count() == top.select("HOM_HOMICIDE_ID").distinct().count()
    # the chosen code is the smallest non-NULL code of the homicide
    codes = H.weapon_codes(t, H.homicide_scope(t, P)).groupBy("HOM_HOMICIDE_ID").agg(F.min("HIERARCHY").alias("m"))
    assert top.join(codes, "HOM_HOMICIDE_ID").where(~F.col("HIERARCHY").eqNullSafe(F.col("m"))).count() == 0
