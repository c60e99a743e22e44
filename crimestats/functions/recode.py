"""Column recodes of the supplementary homicide report.

Every function takes column *names* and returns one ``CASE WHEN`` expression
built from the fixed tables in ``crimestats.functions.codes``: first match
wins, and NULL inputs follow SQL three-valued logic (an unknown condition
never matches).  The CASE text is generated from the tables and handed to
Spark as a single SQL expression (``F.expr``): Catalyst gets exactly the same
expression tree as a chain of ``F.when`` calls, without thousands of
driver-to-JVM calls to assemble it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crimestats.functions import codes as C
from crimestats.functions.predicates import like_any, not_like_any

AS_TEXT = object()  # text_band result: the number itself, as text


# ----------------------------------------------------------------- SQL helpers
def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"


def ident(name: str) -> str:
    return name if name.startswith("`") or not name.replace("_", "").isalnum() else f"`{name}`"


def sql_in(col: str, values: Iterable[str]) -> str:
    return f"{ident(col)} IN ({', '.join(q(v) for v in values)})"


def sql_case(arms: Sequence[tuple[str, str]], otherwise: str = "CAST(NULL AS STRING)") -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in arms) + f" ELSE {otherwise} END"


def first_char_in(col: str, letters: Iterable[str]) -> str:
    return f"substring({ident(col)}, 1, 1) IN ({', '.join(q(v) for v in letters)})"


# ------------------------------------------------------------- generic recodes
def code_map(col: str, rules: Iterable[tuple[tuple[str, ...] | None, str]], otherwise: str | None = None) -> Column:
    """Ordered first-match recode.  ``values=None`` matches a NULL input;
    an input matching no rule gets ``otherwise`` (NULL by default)."""
    arms = [(f"{ident(col)} IS NULL" if values is None else sql_in(col, values), q(code)) for values, code in rules]
    return F.expr(sql_case(arms, "CAST(NULL AS STRING)" if otherwise is None else q(otherwise)))


def text_band(col: str, bands: Sequence[tuple[str, str | None, object]], otherwise: str | None = None,
              guard: str | None = None) -> Column:
    """Compare the *text* of a number with text bounds (binary order, so
    '100' lies between '02' and '98').  ``bands`` = (lo, hi, result); ``hi``
    None means ``>= lo``; result ``AS_TEXT`` is the number as text; a
    ``guard`` (SQL predicate) is ANDed into every band."""
    text = f"CAST({ident(col)} AS STRING)"
    arms = []
    for lo, hi, result in bands:
        cond = f"{text} >= {q(lo)}" if hi is None else f"{text} BETWEEN {q(lo)} AND {q(hi)}"
        if guard is not None:
            cond = f"({guard}) AND {cond}"
        arms.append((cond, text if result is AS_TEXT else q(result)))
    return F.expr(sql_case(arms, "CAST(NULL AS STRING)" if otherwise is None else q(otherwise)))


# ---------------------------------------------------------------- weapons (H1)
def weapon_code(injury: str, weapon_type: str, weapon_name: str) -> Column:
    """2-character weapon code.  Every arm but the two injury arms requires a
    weapon-type injury, so a NULL injury gives NULL."""
    inj, wt, wn = ident(injury), ident(weapon_type), ident(weapon_name)
    armed = sql_in(injury, C.NON_WEAPON_INJURIES).replace(" IN ", " NOT IN ", 1)
    arms = []
    for kind, value, code in C.WEAPON_RULES:
        if kind == "name":
            cond = f"{armed} AND {wn} = {q(value)}"
        elif kind == "type":
            cond = f"{armed} AND {wt} = {q(value)}"
        elif kind == "type+name":
            cond = f"{armed} AND {wt} = {q(value[0])} AND {wn} = {q(value[1])}"
        elif kind == "type+injury":
            cond = f"{armed} AND {wt} = {q(value[0])} AND {inj} = {q(value[1])}"
        elif kind == "injury":
            cond = f"{inj} = {q(value)}"
        else:
            raise ValueError(kind)
        arms.append((cond, q(code)))
    return F.expr(sql_case(arms))


# -------------------------------------------------------- circumstance (H5)
def circumstance_code(death_cause: str, victim_age: str) -> Column:
    """Motive code -> circumstance code; the age split compares numbers."""
    age = ident(victim_age)
    arms = []
    for values, code in C.CIRCUMSTANCE_RULES:
        cond = sql_in(death_cause, values)
        if code == "AGE_SPLIT":
            arms.append((f"{cond} AND {age} > {C.AGE_SPLIT_AT}", q(C.AGE_SPLIT_ADULT)))
            arms.append((f"{cond} AND {age} < {C.AGE_SPLIT_AT + 1}", q(C.AGE_SPLIT_MINOR)))
        else:
            arms.append((cond, q(code)))
    return F.expr(sql_case(arms))


# ---------------------------------------------------------- master recodes
def homicide_type(homicide_no: str) -> Column:
    """H6a: 'B' for involuntary manslaughter, else 'A' (a NULL number too)."""
    return F.expr(sql_case([(first_char_in(homicide_no, [C.INVOLUNTARY_CLASS]), q("B"))], q("A")))


def circumstance_class(homicide_no: str, last_name: str, first_name: str, circumstance: str) -> Column:
    """Justified by police '81' (a name carries a badge mark), justified
    by a citizen '80', involuntary ' ', else the motive's circumstance code.
    The citizen arm is the OR of NOT LIKE tests: true once any name misses any
    pattern (SURVEY T15)."""
    names = [F.col(ident(last_name)), F.col(ident(first_name))]
    patterns = list(C.POLICE_NAME_PATTERNS)
    justified = F.expr(first_char_in(homicide_no, [C.JUSTIFIED_CLASS]))
    involuntary = F.expr(first_char_in(homicide_no, [C.INVOLUNTARY_CLASS]))
    return (F.when(justified & like_any(names, patterns), F.lit(C.POLICE_CIRCUMSTANCE))
            .when(justified & not_like_any(names, patterns), F.lit(C.CITIZEN_CIRCUMSTANCE))
            .when(involuntary, F.lit(" ")).otherwise(F.col(ident(circumstance))))


def victim_age_band(age: str) -> Column:
    """H6c: ' ' for 1, the number for '02'..'98' as text, '99' from '99' up."""
    return text_band(age, [("1", "1", " "), ("02", "98", AS_TEXT), ("99", None, "99")])


def offender_age_band(age: str, shown: str) -> Column:
    """When shown, the number for '01'..'98' as text, '99' from '99' up;
    otherwise (or out of band) '00'."""
    return text_band(age, [("01", "98", AS_TEXT), ("99", None, "99")], otherwise="00", guard=shown)


def victim_sex(sex: str) -> Column:
    return F.expr(sql_case([(f"{ident(sex)} = 'M'", "'M'"), (f"{ident(sex)} = 'F'", "'F'")]))


def _group_pairs(pairs) -> list[tuple[tuple[str, ...], str]]:
    """(value, code) pairs -> (values, code) rules, keeping first-seen order."""
    grouped: dict[str, list[str]] = {}
    for value, code in pairs:
        grouped.setdefault(code, []).append(value)
    return [(tuple(values), code) for code, values in grouped.items()]


def victim_race(race: str) -> Column:
    return code_map(race, _group_pairs(C.VICTIM_RACE) + [(None, " "), (C.VICTIM_UNKNOWN_RACE, " ")])


def victim_ethnicity(race: str) -> Column:
    return code_map(race, _group_pairs(C.VICTIM_ETHNICITY) + [(None, " "), (C.VICTIM_UNKNOWN_RACE, " ")])


def offender_shown(situation: str, last_name: str) -> str:
    """SQL predicate: offender details are reported only for a known offender
    (situation not B/F) with a recorded last name; NULL situation: not shown."""
    return (f"{sql_in(situation, C.UNKNOWN_OFFENDER_SITUATIONS).replace(' IN ', ' NOT IN ', 1)}"
            f" AND {ident(last_name)} IS NOT NULL")


def offender_sex(sex: str, shown: str) -> Column:
    return F.expr(sql_case([(f"({shown}) AND {ident(sex)} = 'M'", "'M'"),
                            (f"({shown}) AND {ident(sex)} = 'F'", "'F'")], "'U'"))


def _offender_map(race: str, shown: str, pairs) -> Column:
    arms = [(f"({shown}) AND {sql_in(race, values)}", q(code)) for values, code in _group_pairs(pairs)]
    return F.expr(sql_case(arms, "'U'"))


def offender_race(race: str, shown: str) -> Column:
    return _offender_map(race, shown, C.OFFENDER_RACE)


def offender_ethnicity(race: str, shown: str) -> Column:
    return _offender_map(race, shown, C.OFFENDER_ETHNICITY)


#: Columns that a relationship is looked up to: its code for a male, a female and any other victim.
RELATION_FIELDS = ("__rel_m", "__rel_f", "__rel_other")


def relation_rows() -> list[tuple[str | None, ...]]:
    """One row per relationship text: the text, then RELATION_FIELDS."""
    rows = [(value, code, code, code) for values, code in C.RELATION_CODES if values is not None for value in values]
    by_sex: dict[str, dict[str, str]] = {}
    for value, sex, code in C.RELATION_BY_SEX:
        by_sex.setdefault(value, {})[sex] = code
    return rows + [(value, codes.get("M"), codes.get("F"), None) for value, codes in by_sex.items()]


def relationship_code(relation: str, sex: str, situation: str | None) -> Column:
    """H6f: victim's relationship to the offender -> 2-character code;
    unknown-offender situations and a relationship not recorded are 'UN'; an
    unmapped text is NULL.  ``situation=None`` means no situation is known (NULL).
    The guards around RELATION_FIELDS, looked up before (``relational.with_codes``)."""
    arms = [] if situation is None else [(sql_in(situation, C.UNKNOWN_OFFENDER_SITUATIONS), q(C.UNKNOWN_RELATION))]
    arms.append((f"{ident(relation)} IS NULL", q(C.UNKNOWN_RELATION)))
    male, female, other = RELATION_FIELDS
    arms += [(f"{ident(sex)} = 'M'", male), (f"{ident(sex)} = 'F'", female)]
    return F.expr(sql_case(arms, other))
