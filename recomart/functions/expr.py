"""Row-wise business expressions as Spark Column functions.

Every function returns a plain ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; nothing here is a UDF. Names follow
the inventory IDs (D1 ... D35, F1 ... F10) in the docstrings.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import labels as L

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """F8: reporting date. ``None`` means CURRENT_DATE(); pass a date for repeatable runs."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs, value_type: str | None = None) -> Column:
    """A literal map column (one expression, parsed once)."""
    body = ", ".join(f"{_sql_lit(k)}, {_sql_lit(v)}" for k, v in pairs)
    m = F.expr(f"map({body})")
    return m.cast(f"map<string,{value_type}>") if value_type else m


def _lookup(col: ColumnOrName, table, pick, default, dtype: str | None = None) -> Column:
    """First-match CASE over disjoint (answers, ...) rows, as one literal-map probe.

    ``map_contains_key`` keeps "answer found, value NULL" apart from "not found"
    (which takes the default), exactly like the CASE ... ELSE it replaces; a
    NULL input is "not found"."""
    pairs = [(a, pick(row)) for row in table for a in row[0]]
    vtype = dtype or "string"
    if isinstance(col, str):
        # one parsed expression instead of a chain of driver round-trips
        body = ", ".join(f"{_sql_lit(k)}, {_sql_lit(v)}" for k, v in pairs)
        m = f"CAST(map({body}) AS MAP<STRING, {vtype.upper()}>)"
        ref = "`" + col.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN map_contains_key({m}, {ref}) THEN try_element_at({m}, {ref}) "
                      f"ELSE CAST({_sql_lit(default)} AS {vtype.upper()}) END")
    c = _c(col)
    m = literal_map(pairs, vtype)
    d = F.lit(default).cast(vtype)
    return F.when(F.map_contains_key(m, c), F.try_element_at(m, c)).otherwise(d)


# -- D1, D5, D6, D7 ---------------------------------------------------------------
def rent_duration_class(col: ColumnOrName) -> Column:
    """Bilingual max-rent-duration answer -> '<1 mo' ... '>6 mo', else 'undefined'."""
    return _lookup(col, L.MAX_RENT_DURATION, lambda r: r[1], L.UNDEFINED)


def rent_duration_typical_nights(col: ColumnOrName) -> Column:
    """Typical nights per duration class (15/30/60/120/200, else 0)."""
    return _lookup(col, L.MAX_RENT_DURATION, lambda r: r[2], 0, "long")


def rent_duration_min_nights(col: ColumnOrName) -> Column:
    """Minimum nights (1/30/31/91/181, else 0)."""
    return _lookup(col, L.MAX_RENT_DURATION, lambda r: r[3], 0, "long")


def rent_duration_max_nights(col: ColumnOrName) -> Column:
    """Maximum nights (29/30/89/179/360, else 0)."""
    return _lookup(col, L.MAX_RENT_DURATION, lambda r: r[4], 0, "long")


# -- D2, D2b, D3 -----------------------------------------------------------------
def rent_per_person_class(col: ColumnOrName, unsure_as_null: bool = False) -> Column:
    """D2 (unsure kept as 'unsure') / D2b (unsure -> NULL); else 'undefined'."""
    def pick(r):
        return None if (unsure_as_null and r[1] == L.UNSURE_CLASS) else r[1]
    return _lookup(col, L.RENT_PER_PERSON, pick, L.UNDEFINED, "string")


def rent_per_person_number(col: ColumnOrName) -> Column:
    """D3: 0 / 250 / 500 / 1000, unsure -> NULL, else 0."""
    return _lookup(col, L.RENT_PER_PERSON, lambda r: r[2], 0, "long")


# -- D4, D8, D8b -----------------------------------------------------------------
def pets_answer(col: ColumnOrName) -> Column:
    """Maybe / no / yes, else 'undefined'."""
    return _lookup(col, L.PETS_POSSIBLE, lambda r: r[1], L.UNDEFINED)


def pets_bool(col: ColumnOrName) -> Column:
    """No -> false, yes -> true, anything else NULL."""
    c = _c(col)
    rows = [r for r in L.PETS_POSSIBLE if r[2] is not None]
    out = None
    for answers, _, val in rows:
        out = F.when(c.isin(*answers), F.lit(val)) if out is None else out.when(c.isin(*answers), F.lit(val))
    return out


def pets_flag(col: ColumnOrName) -> Column:
    """Yes -> 1, anything else 0."""
    c = _c(col)
    yes = [r for r in L.PETS_POSSIBLE if r[2] is True][0][0]
    return F.when(c.isin(*yes), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


# -- D9 / D10 families: "has pets" / "has disability" ------------------------------
def _literal_no(col: ColumnOrName) -> Column:
    # The answers contain '%' but are compared literally (IN list, not LIKE).
    return _c(col).isin(*L.LITERAL_NO_ANSWERS)


def _like_any(col: ColumnOrName, patterns, empty_is_no: bool) -> Column:
    low = F.lower(_c(col))
    preds = [low.like(p) for p in patterns]
    if empty_is_no:
        preds.append(low == F.lit(""))
    return reduce(lambda a, b: a | b, preds)


def _yes_unless(pred: Column, as_int: bool) -> Column:
    # CASE WHEN pred THEN no ELSE yes: a NULL predicate falls to ELSE (yes).
    if as_int:
        return F.when(pred, F.lit(0).cast("long")).otherwise(F.lit(1).cast("long"))
    return F.when(pred, F.lit(False)).otherwise(F.lit(True))


def has_pets(col: ColumnOrName, rule: str = "literal", as_int: bool = False) -> Column:
    """D9 (literal, bool) / D9b (literal, 0/1) / D9c (rule 'like_c') / D9d (rule 'like_d')."""
    if rule == "literal":
        return _yes_unless(_literal_no(col), as_int)
    if rule == "like_c":
        return _yes_unless(_like_any(col, L.PETS_NO_LIKE_C, False), as_int)
    if rule == "like_d":
        return _yes_unless(_like_any(col, L.PETS_NO_LIKE_D, True), as_int)
    raise ValueError(rule)


def has_disability(col: ColumnOrName, rule: str = "literal", as_int: bool = True) -> Column:
    """D10 (literal) / D10b (rule 'like_b') / D10c (rule 'like_c'); 0/1 by default."""
    if rule == "literal":
        return _yes_unless(_literal_no(col), as_int)
    if rule == "like_b":
        return _yes_unless(_like_any(col, L.DISABILITY_NO_LIKE_B, False), as_int)
    if rule == "like_c":
        return _yes_unless(_like_any(col, L.DISABILITY_NO_LIKE_C, True), as_int)
    raise ValueError(rule)


# -- D11, D12, D32, D33, D34 --------------------------------------------------------
def status_onehot(col: ColumnOrName, status: str) -> Column:
    """IF(status = s, 1, 0) -- NULL status gives 0."""
    return F.when(_c(col) == F.lit(status), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """DATE_DIFF(later, earlier, DAY) as a long (NULL propagates)."""
    return F.datediff(F.to_date(_c(later)), F.to_date(_c(earlier))).cast("long")


def days_since(col: ColumnOrName, as_of=None) -> Column:
    """Days from DATE(col) to the reporting date."""
    return F.datediff(as_of_date(as_of), F.to_date(_c(col))).cast("long")


def nights_spent_floored(col: ColumnOrName, as_of=None) -> Column:
    """Days since DATE(col), negative -> 0, NULL stays NULL (not greatest())."""
    d = days_since(col, as_of)
    return F.when(d < 0, F.lit(0).cast("long")).otherwise(d)


def occupancy_flags(won: ColumnOrName, open_: ColumnOrName, lost: ColumnOrName) -> tuple[Column, Column]:
    """(is_occupied, has_requests) from the one-hot status columns."""
    occupied = F.when(_c(won) == 1, F.lit(True)).otherwise(F.lit(False))
    requests = F.when((_c(open_) == 1) | (_c(lost) == 1), F.lit(True)).otherwise(F.lit(False))
    return occupied, requests


def adults(people: ColumnOrName, children: ColumnOrName) -> Column:
    """People - children (NULL propagates)."""
    return _c(people) - _c(children)


def merged_lower(prd: ColumnOrName, pd: ColumnOrName) -> Column:
    """lower(coalesce(prd, pd))."""
    return F.lower(F.coalesce(_c(prd), _c(pd)))


# -- D13, D14 ------------------------------------------------------------------------
def needed_months_otherwise(exact: Column, col: ColumnOrName) -> Column:
    """D13 after the exact answers: the LIKE rules in order, then 'Unknown'."""
    c = _c(col)
    like = None
    for pat, cls in L.NEEDED_MONTHS_LIKE:
        like = F.when(c.like(pat), F.lit(cls)) if like is None else like.when(c.like(pat), F.lit(cls))
    return F.coalesce(exact, like.otherwise(F.lit(L.NEEDED_MONTHS_UNKNOWN)))


def needed_months_class(col: ColumnOrName) -> Column:
    """D13 as one expression: free-text needed months -> class. Exact (code point) equality first, by a search of a
    literal map (its entries one by one), then the LIKE rules, then 'Unknown'. Over tables, the
    dictionary join of ``plans.deals.with_needed_months`` gives the same."""
    return needed_months_otherwise(F.try_element_at(literal_map(L.NEEDED_MONTHS_EQUALS), _c(col)), col)


def needed_months_nights(col: ColumnOrName) -> Column:
    """Typical nights per D13 class (15/30/60/120/360, else 0)."""
    c = _c(col)
    out = None
    for cls, n in L.NEEDED_MONTHS_NIGHTS:
        v = F.lit(n).cast("long")
        out = F.when(c == F.lit(cls), v) if out is None else out.when(c == F.lit(cls), v)
    return out.otherwise(F.lit(0).cast("long"))


# -- D18, D19, D19b ------------------------------------------------------------------
def price_class(col: ColumnOrName) -> Column:
    """0 -> for_free, <250, [250,500), >=500, NULL -> NULL (negative -> '<250 mo')."""
    p = _c(col)
    return (F.when(p == 0, F.lit(L.PRICE_FREE))
            .when(p < 250, F.lit(L.PRICE_LOW))
            .when((p >= 250) & (p < 500), F.lit(L.PRICE_MID))
            .when(p >= 500, F.lit(L.PRICE_HIGH)))


def _nights_bucket(gate_null: Column, n: Column) -> Column:
    return (F.when(gate_null & (n < 30), F.lit(L.NIGHTS_LT_1))
            .when(gate_null & (n == 30), F.lit(L.NIGHTS_1))
            .when(gate_null & (n > 30) & (n < 90), F.lit(L.NIGHTS_1_3))
            .when(gate_null & (n > 90) & (n < 180), F.lit(L.NIGHTS_3_6))
            .when(gate_null & (n >= 180), F.lit(L.NIGHTS_GT_6)))


def stay_class(crm_class: ColumnOrName, nights: ColumnOrName) -> Column:
    """CRM class when present, else bucket the product nights; exactly 90 -> NULL."""
    k = _c(crm_class)
    return _nights_bucket(k.isNull(), _c(nights)).when(k.isNotNull(), k)


def stay_class_gated(gate: ColumnOrName, emitted: ColumnOrName, nights: ColumnOrName) -> Column:
    """Bucket when ``gate`` is NULL; ``emitted`` (another column) when it is not;
    else 'Unknown'."""
    g = _c(gate)
    return _nights_bucket(g.isNull(), _c(nights)).when(g.isNotNull(), _c(emitted)).otherwise(
        F.lit(L.NEEDED_MONTHS_UNKNOWN))


# -- reconciliation rules (D20 ... D31) -------------------------------------------
def source_flag(pd_key: ColumnOrName, prd_key: ColumnOrName) -> Column:
    """Both / CRM only / product only from key presence; NULL if neither."""
    a, b = _c(pd_key), _c(prd_key)
    return (F.when(a.isNotNull() & b.isNotNull(), F.lit(L.BOTH))
            .when(a.isNotNull() & b.isNull(), F.lit(L.CRM_ONLY))
            .when(a.isNull() & b.isNotNull(), F.lit(L.PRODUCT_ONLY)))


def prefer(first: ColumnOrName, second: ColumnOrName) -> Column:
    """First non-NULL of (first, second)."""
    return F.coalesce(_c(first), _c(second))


def only_when_null(gate: ColumnOrName, value: ColumnOrName) -> Column:
    """Value only where ``gate`` is NULL."""
    return F.when(_c(gate).isNull(), _c(value))


def by_presence(prd_gate: ColumnOrName, prd_value: ColumnOrName,
                pd_gate: ColumnOrName, pd_value: ColumnOrName) -> Column:
    """Product value (even NULL) once the product gate is set, else the
    CRM value once the CRM gate is set, else NULL."""
    return (F.when(_c(prd_gate).isNotNull(), _c(prd_value))
            .when(_c(pd_gate).isNotNull(), _c(pd_value)))


def when_present(gate: ColumnOrName, value: ColumnOrName) -> Column:
    """Value only when the gate (product e-mail) is present."""
    return F.when(_c(gate).isNotNull(), _c(value))


def unified_id_gated(pd_id: ColumnOrName, prd_id: ColumnOrName, prd_gate: ColumnOrName) -> Column:
    """Product id when both ids exist or the product gate is set; CRM id when
    the product gate is NULL; NULL for a product row without the gate."""
    a, b, g = _c(pd_id), _c(prd_id), _c(prd_gate)
    return (F.when(a.isNotNull() & b.isNotNull(), b)
            .when(a.isNull() & g.isNotNull(), b)
            .when(a.isNotNull() & g.isNull(), a))


def booked_to_quirk(pd_id: ColumnOrName, prd_id: ColumnOrName,
                    booked_from: ColumnOrName, booked_to: ColumnOrName) -> Column:
    """booked_to for matched rows, booked_from otherwise."""
    return F.when(_c(pd_id).isNotNull() & _c(prd_id).isNotNull(), _c(booked_to)).otherwise(_c(booked_from))


def flag_gated(flag: ColumnOrName, value: ColumnOrName) -> Column:
    """Value only when the source flag includes the product side."""
    return F.when(_c(flag).isin(L.PRODUCT_ONLY, L.BOTH), _c(value))


def true_or_null(pred: Column) -> Column:
    """D20c building block: TRUE when ``pred`` holds, NULL otherwise."""
    return F.when(pred, F.lit(True))


def flag_from_truth(in_product: ColumnOrName, in_crm: ColumnOrName, both: ColumnOrName) -> Column:
    """First IS TRUE test wins."""
    return (F.when(_c(in_product).eqNullSafe(True), F.lit(L.PRODUCT_ONLY))
            .when(_c(in_crm).eqNullSafe(True), F.lit(L.CRM_ONLY))
            .when(_c(both).eqNullSafe(True), F.lit(L.BOTH)))


def to_bool(col: ColumnOrName) -> Column:
    """CAST(x AS BOOL) of the warehouse: only true and false, in any case; NULL for other text."""
    text = F.lower(_c(col))
    return F.when(text == "true", True).when(text == "false", False)


def number_text(col: ColumnOrName) -> Column:
    """F4 for numbers, as the warehouse writes them: the digits of a C ``%.15g`` (``%.17g`` where 15 digits do not
    give the number back), so no trailing '.0', no sign of zero, and an exponent of at least two digits below 1e-4
    and where the whole part has more than 15 (17) digits.

    One plain cast for each kind of number, in codegen: whole numbers as integers, fractions that Spark
    writes without an exponent as they are, the few others by way of a decimal. Only numbers that keep an
    exponent are taken apart. Numbers that need 16 or 17 digits, and those below 1e-307, get the
    shortest digits that give them back."""
    c = _c(col)
    size = F.abs(c)
    text = c.cast("string")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).cast("int")
    digits = F.length(F.translate(mantissa, "-.", ""))
    exponent = F.concat(F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    scientific = F.when((digits > 15) & (power.between(15, 16)), c.try_cast("decimal(20,0)").cast("string")).otherwise(
        F.concat(mantissa, F.when(F.abs(power) < 100, exponent).otherwise(
            F.concat(F.when(power < 0, "e-").otherwise("e+"), F.abs(power).cast("string")))))
    whole = c.try_cast("bigint")
    return (F.when((size < 1e15) & (c == whole), whole.cast("string"))
            .when((size >= 1e-3) & (size < 1e7), text)
            .when((size >= 1e-4) & (size < 1e15), F.rtrim(c.try_cast("decimal(38,22)").cast("string"), F.lit("0")))
            .when(F.isnan(c), "NaN")
            .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
            .when(c.isNotNull(), scientific))
