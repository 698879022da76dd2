"""DuckDB oracle SQL for the per-operator inventory queries."""

from __future__ import annotations

from recomart.plans.inventory import MART_RULES

from .adapter import LABELS as L, adapter_ctes, q
from .marts import (ASOF, EXCLUDED, MART_SQL, case_in, days, disability_sql, floored, has_pets_sql,
                    needed_months_sql, number_text_sql, price_class_sql, staged_cols, stay_class_sql)


def w(body: str) -> str:
    return f"WITH {adapter_ctes()}\n{body}"


USER = "'user' || CAST(cust AS VARCHAR) || '@mail.example'"
OLD = "'old' || CAST(cust AS VARCHAR) || '@mail.example'"
DUR, RENT, PETS = "_ll_maximum_rent_duration_possible_", "_ll_rent_per_person_", "_ll_pets_possible_"
PAIRS = "(SELECT DISTINCT listing_id, pets_allowed FROM listing_requests)"


def _fallback(first: str, second: str, c: str) -> str:
    return f"CASE WHEN {first}.{c} IS NULL THEN {second}.{c} ELSE {first}.{c} END"


def enriched_sql(core_first: bool, cols: str) -> str:
    a, b = ("c", "r") if core_first else ("r", "c")
    fb = lambda c: _fallback(a, b, c)
    return w(f"""SELECT {cols} FROM (
  SELECT bk.booking_id, {fb('price')} AS price, {fb('city')} AS city, {fb('beds')} AS beds,
         {fb('is_online')} AS is_online
  FROM bookings bk LEFT JOIN core_listings c ON bk.listing_id = c.listing_id
  LEFT JOIN listings r ON r.listing_id = bk.listing_id
  LEFT JOIN {PAIRS} p ON r.listing_id = p.listing_id)""")


WON_LL = (f"(SELECT CAST(id AS VARCHAR) AS id, email FROM deal_emails WHERE pipeline_id = 2 AND status = 'won' "
          f"AND COALESCE(lost_reason, 'undefined') NOT IN ({EXCLUDED}))")


def rowwise(expr: str, raw: str, name: str) -> str:
    return w(f"SELECT id, {raw} AS raw, {expr} AS {name} FROM deals")


SQL: dict[str, str] = {
    "s1": w("""SELECT id, pipeline_id, status,
  CASE WHEN e_mode IN (0, 1) THEN NULL WHEN e_mode = 2 THEN 0 WHEN e_mode IN (3, 6) THEN 1 ELSE 2 END::BIGINT
    AS n_emails,
  CASE WHEN ll_mode = 0 THEN NULL WHEN ll_mode = 1 THEN 0 WHEN ll_mode = 2 THEN 1 ELSE 2 END::BIGINT AS n_cities
FROM deals"""),
    "s2": w("SELECT * FROM bookings"),
    "s3": w("SELECT * FROM listings"),
    "s4": w("SELECT * FROM core_listings"),
    "s5": w("SELECT * FROM listing_requests"),
    "s6": w("""SELECT 'landlord' AS kind, landlord_id AS dim_id, freshworks_email AS email FROM landlords
UNION ALL SELECT 'user', user_id, email FROM users
UNION ALL SELECT 'tenant', tenant_id, NULL FROM tenants"""),
    "s7": w("""SELECT listing_id, count(*) AS n_bookings, min(booked_from) AS first_booked_from
FROM bookings GROUP BY listing_id"""),
    "s8": MART_SQL["m3"](),
    "p1": w("""SELECT booking_id AS prd_bookingid, booked_from AS prd_booked_from, booked_to AS prd_booked_to,
  listing_id AS prd_listing_id FROM bookings"""),
    "p2": w("SELECT * FROM landlords"),
    "p3": w(f"SELECT prd.*, lr.pets_allowed FROM listings prd LEFT JOIN {PAIRS} lr ON prd.listing_id = lr.listing_id"),
    "p4": w(f"SELECT *, {days('requested_to', 'requested_from')} AS rent_duration FROM listing_requests"),
    "p5": w("SELECT 'Pipedrive' AS data_source, id FROM deals"),
    "p6": w("""SELECT listing_id, CAST(NULL AS BIGINT) AS pd_total_beds_edit_team1,
  CAST(NULL AS VARCHAR) AS pd_max_rent_duration, CAST(NULL AS BOOLEAN) AS pd_flag FROM listings"""),
    "p7": w(f"""SELECT id,
  CASE WHEN e_mode IN (0, 1, 2, 6) THEN NULL WHEN e_mode IN (3, 4, 5) THEN {USER} ELSE {OLD} END AS first_email,
  CASE WHEN e_mode IN (0, 1, 2) THEN NULL WHEN e_mode = 3 THEN FALSE WHEN e_mode IN (4, 5, 6) THEN TRUE
       ELSE FALSE END AS first_is_primary
FROM deals"""),
    "p8": w("""SELECT id, CASE WHEN e_mode IN (0, 1) THEN NULL WHEN e_mode IN (2, 3) THEN 0
  WHEN e_mode IN (4, 5) THEN 2 ELSE 1 END::BIGINT AS n_primary FROM deals"""),
    "p9": w("SELECT id, title FROM deals WHERE pipeline_id = 2 AND status = 'won'"),
    "p10": w(f"""SELECT id, COALESCE(lost_reason, 'undefined') AS lost_reason FROM deals
WHERE COALESCE(lost_reason, 'undefined') NOT IN ({EXCLUDED})"""),
    "p11": w("""SELECT b.booking_id, c.city AS core_city FROM bookings b
JOIN core_listings c ON b.listing_id = c.listing_id"""),
    "p12": w("""SELECT ls.listing_id, ls.landlord_id FROM listings ls
LEFT JOIN landlords ll ON ls.landlord_id = ll.landlord_id WHERE ll.freshworks_email IS NULL"""),
    "p13": w(f"""SELECT id, {DUR} AS answer FROM deals WHERE {DUR} IN
  ({', '.join(q(a) for row in L.MAX_RENT_DURATION for a in row[0])})"""),
    "p14": w(f"""SELECT id, te_pets_cleaned AS answer FROM deals
WHERE te_pets_cleaned IN ({', '.join(q(a) for a in L.LITERAL_NO_ANSWERS)})"""),
    "p15": w("""SELECT id, lower(te_pets_cleaned) LIKE '%no%' AS contains_no,
  lower(te_pets_cleaned) LIKE 'none%' AS starts_none, lower(te_pets_cleaned) LIKE '%without' AS ends_without,
  lower(te_pets_cleaned) LIKE '%without%' AS contains_without FROM deals"""),
    "p16": w("""SELECT id, CASE WHEN _te_needed_months_to_rent_ LIKE '%know%' THEN 'Unknown'
  WHEN _te_needed_months_to_rent_ LIKE '%indef%' THEN '>6 mo' END AS like_class FROM deals"""),
    "p17": w(f"""SELECT booking_id, {days('booked_to', 'booked_from')} AS nights,
  {stay_class_sql('CAST(NULL AS VARCHAR)', days('booked_to', 'booked_from'))} AS bucket FROM bookings"""),
    "p18": w("""SELECT listing_id, is_bookable AND is_online AS both_flags, is_bookable OR is_online AS any_flag,
  city IS NULL AS no_city, city IS NOT NULL AND price IS NULL AS city_without_price FROM listings"""),
    "p19": w("""SELECT listing_id, is_bookable IS TRUE AS bookable_is_true, is_online IS NOT TRUE AS online_is_not_true
FROM listings"""),
    "p20": w("SELECT id, te_priority, te_priority AS deal_priority FROM deals"),
    "j1": w("SELECT id, email FROM deal_emails"),
    "j2": w("SELECT id, email, city_elem AS city FROM ll_city_rows"),
    "j3": w("""SELECT id, email, CASE WHEN ll_mode IN (0, 1) THEN NULL ELSE CAST(city_pos AS BIGINT) END AS pos,
  city_elem AS city FROM ll_city_rows"""),
    "j4": w(f"""SELECT pd.id AS pd_id, pd.email AS pd_email, prd.booking_id AS prd_booking_id,
  prd.freshworks_email AS prd_email
FROM {WON_LL} pd FULL JOIN (SELECT b.booking_id, l.freshworks_email FROM bookings b
  LEFT JOIN landlords l ON b.landlord_id = l.landlord_id) prd ON pd.email = prd.freshworks_email"""),
    "j5a": w("""SELECT b.booking_id, c.city AS core_city, c.price AS core_price FROM bookings b
LEFT JOIN core_listings c ON b.listing_id = c.listing_id"""),
    "j5b": w("""SELECT b.booking_id, cb.price AS core_price FROM bookings b LEFT JOIN (
  SELECT x.booking_id, c.price FROM bookings x JOIN core_listings c ON x.listing_id = c.listing_id) cb
  ON b.booking_id = cb.booking_id"""),
    "j5c": w("""SELECT b.booking_id, r.city AS rfg_city, r.price AS rfg_price FROM bookings b
LEFT JOIN listings r ON r.listing_id = b.listing_id"""),
    "j5d": w(f"SELECT ls.listing_id, p.pets_allowed FROM listings ls LEFT JOIN {PAIRS} p ON ls.listing_id = p.listing_id"),
    "j5e": w("""SELECT ls.listing_id, ll.freshworks_email FROM listings ls
LEFT JOIN landlords ll ON ll.landlord_id = ls.landlord_id"""),
    "j5f": w("SELECT b.booking_id, u.email FROM bookings b LEFT JOIN users u ON u.user_id = b.tenant_id"),
    "j5g": w("""SELECT lr.listing_request_id, te.tenant_id AS t_tenant_id FROM listing_requests lr
LEFT JOIN tenants te ON te.tenant_id = lr.tenant_id"""),
    "j5h": w("""SELECT lr.listing_request_id, ls.is_online AS ls_is_online, ls.beds AS ls_beds
FROM listing_requests lr LEFT JOIN listings ls ON ls.listing_id = lr.listing_id"""),
    "j5i": w("""SELECT rb.booking_id, rb.listing_id, cb.city AS core_city FROM (
  SELECT b.booking_id, c.city FROM bookings b LEFT JOIN core_listings c ON b.listing_id = c.listing_id) cb
LEFT JOIN bookings rb ON rb.booking_id = cb.booking_id"""),
    "j5j": w(f"""SELECT pd.id, pd.email, ll.landlord_id FROM {WON_LL} pd
LEFT JOIN landlords ll ON pd.email = ll.freshworks_email"""),
    "j5k": w(f"""SELECT ll.landlord_id, ll.freshworks_email, pd.id FROM landlords ll
LEFT JOIN {WON_LL} pd ON ll.freshworks_email = pd.email"""),
    "j5r": w("""SELECT ls.listing_id, ll.landlord_id AS l_id, ll.freshworks_email FROM landlords ll
RIGHT JOIN listings ls ON ll.landlord_id = ls.landlord_id"""),
    "j6": w("""SELECT b.booking_id, c.price AS core_price FROM bookings b
LEFT JOIN core_listings c ON b.listing_id = c.listing_id WHERE c.listing_id IS NOT NULL"""),
    "j7": w(f"""SELECT ls.listing_id, ll.freshworks_email FROM listings ls
LEFT JOIN landlords ll ON ll.landlord_id = ls.landlord_id
LEFT JOIN (SELECT email FROM deal_emails WHERE pipeline_id = 2
           AND COALESCE(lost_reason, 'undefined') NOT IN ({EXCLUDED})) pd ON ll.freshworks_email = pd.email
WHERE pd.email IS NULL"""),
    "a1": w("""SELECT id, email, string_agg(te_city, ',' ORDER BY te_city) AS cities FROM te_city_rows
GROUP BY id, email"""),
    "a3": w("SELECT DISTINCT listing_id, pets_allowed FROM listing_requests"),
    "u1": w("SELECT landlord_id, freshworks_email FROM landlords UNION ALL SELECT user_id, email FROM users"),
    "f1": w("SELECT id, COALESCE(lost_reason, 'undefined') AS lost_reason FROM deals"),
    "f2": w("SELECT id, CASE WHEN deleted THEN 'deleted' ELSE 'active' END AS state FROM deals"),
    "f3": w("SELECT id, CASE WHEN status = 'won' THEN 'W' WHEN status = 'lost' THEN 'L' END AS s FROM deals"),
    "f4": w(f"""SELECT listing_request_id, {number_text_sql('listing_price')} AS price_text,
  CAST(adults AS VARCHAR) AS adults_text FROM listing_requests"""),
    "f5": w("SELECT listing_request_id, CASE lower(pets_allowed) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS pets_allowed FROM listing_requests"),
    "f6": w("SELECT id, CAST(add_time AS DATE) AS add_date, CAST(won_time AS DATE) AS won_date FROM deals"),
    "f7": w(f"SELECT booking_id, {days('booked_to', 'booked_from')} AS nights FROM bookings"),
    "f8": w(f"SELECT id, {ASOF} AS report_date, {days(ASOF, 'add_time')} AS days_since_added FROM deals"),
    "f9": w("SELECT listing_id, lower(city) AS city FROM listings"),
    "f10": w("""SELECT id, te_number_of_people_in_the_group_keep_updated - te_number_of_children_under_18_ AS adults
FROM deals"""),
    "d1": rowwise(case_in(DUR, L.MAX_RENT_DURATION, lambda r: r[1], L.UNDEFINED), DUR, "ll_max_rent_duration"),
    "d2": rowwise(case_in(RENT, L.RENT_PER_PERSON, lambda r: r[1], L.UNDEFINED), RENT, "ll_rent_per_person"),
    "d2b": rowwise(case_in(RENT, L.RENT_PER_PERSON, lambda r: None if r[1] == L.UNSURE_CLASS else r[1],
                           L.UNDEFINED), RENT, "ll_rent_per_person"),
    "d3": rowwise(case_in(RENT, L.RENT_PER_PERSON, lambda r: r[2], 0), RENT, "ll_rent_per_person_numeric"),
    "d4": rowwise(case_in(PETS, L.PETS_POSSIBLE, lambda r: r[1], L.UNDEFINED), PETS, "ll_pets_allowed"),
    "d5": rowwise(case_in(DUR, L.MAX_RENT_DURATION, lambda r: r[2], 0), DUR, "nights_per_rent_duration"),
    "d6": rowwise(case_in(DUR, L.MAX_RENT_DURATION, lambda r: r[3], 0), DUR, "min_nights_per_rent_duration"),
    "d7": rowwise(case_in(DUR, L.MAX_RENT_DURATION, lambda r: r[4], 0), DUR, "max_nights_per_rent_duration"),
    "d8": rowwise(f"CASE WHEN {PETS} IN ('Nein', 'No') THEN FALSE WHEN {PETS} IN ('Ja', 'Yes') THEN TRUE END",
                  PETS, "ll_pets_allowed_bool"),
    "d8b": rowwise(f"CASE WHEN {PETS} IN ('Nein', 'No') THEN CAST(0 AS BIGINT) WHEN {PETS} IN ('Ja', 'Yes') "
                   f"THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END", PETS, "ll_pets_allowed_bool"),
    "d9": rowwise(has_pets_sql("literal", False), "te_pets_cleaned", "te_has_pets"),
    "d9b": rowwise(has_pets_sql("literal", True), "te_pets_cleaned", "te_has_pets"),
    "d9c": rowwise(has_pets_sql("like_c", False), "te_pets_cleaned", "te_has_pets"),
    "d9d": rowwise(has_pets_sql("like_d", False), "te_pets_cleaned", "te_has_pets"),
    "d10": rowwise(disability_sql("literal"), "te_disabled_help_needed_people_cleaned", "te_has_disability"),
    "d10b": rowwise(disability_sql("like_b"), "te_disabled_help_needed_people_cleaned", "te_has_disability"),
    "d10c": rowwise(disability_sql("like_c"), "te_disabled_help_needed_people_cleaned", "te_has_disability"),
    "d11": w("""SELECT id, status, CASE WHEN status = 'open' THEN 1 ELSE 0 END::BIGINT AS open_deal,
  CASE WHEN status = 'lost' THEN 1 ELSE 0 END::BIGINT AS lost_deal,
  CASE WHEN status = 'won' THEN 1 ELSE 0 END::BIGINT AS won_deal FROM deals"""),
    "d12": w(f"SELECT id, {days(ASOF, 'won_time')} AS nights_from_won_date FROM deals"),
    "d13": rowwise(needed_months_sql("_te_needed_months_to_rent_"), "_te_needed_months_to_rent_",
                   "rent_duration_categorical"),
    "d14": w(f"""SELECT id, cls AS rent_duration_categorical,
  CASE cls WHEN '<1 mo' THEN 15 WHEN '1 mo' THEN 30 WHEN '1-3 mo' THEN 60 WHEN '3-6 mo' THEN 120
           WHEN '>6 mo' THEN 360 ELSE 0 END::BIGINT AS nights_per_rent_duration
FROM (SELECT id, {needed_months_sql('_te_needed_months_to_rent_')} AS cls FROM deals)"""),
    "d15": w(f"SELECT booking_id, {days('booked_to', 'booked_from')} AS nights_per_rent_duration FROM bookings"),
    "d16": w(f"SELECT booking_id, {floored('booked_from')} AS nights_spent FROM bookings"),
    "d17": enriched_sql(False, "booking_id, price, city, beds, is_online"),
    "d17b": enriched_sql(True, "booking_id, price, city, beds, is_online"),
    "d18": w(f"SELECT listing_id, price, {price_class_sql('price')} AS prd_rent_per_person_categorical FROM listings"),
    "d32": w("""SELECT id, email, won_deal = 1 AS ls_is_occupied, open_deal = 1 OR lost_deal = 1 AS ls_has_requests
FROM (SELECT CAST(id AS VARCHAR) AS id, email, CASE WHEN status = 'won' THEN 1 ELSE 0 END AS won_deal,
  CASE WHEN status = 'open' THEN 1 ELSE 0 END AS open_deal, CASE WHEN status = 'lost' THEN 1 ELSE 0 END AS lost_deal
  FROM deal_emails WHERE pipeline_id = 2)"""),
}


def _j8() -> str:
    def fb(c):
        return _fallback("r", "c", c)
    return w(f"""SELECT b.booking_id, ll.freshworks_email AS email, b.landlord_id, b.tenant_id,
  b.actual_booking_created_at AS created_at, b.booked_from, b.booked_to, b.is_canceled, b.listing_id,
  {fb('is_online')} AS is_online, {fb('is_bookable')} AS is_bookable, {fb('is_published')} AS is_published,
  {fb('is_deleted')} AS is_deleted,
  CAST({fb('available_from')} AS DATE) AS listing_available_from,
  CAST({fb('available_to')} AS DATE) AS listing_available_to,
  {days('b.booked_to', 'b.booked_from')} AS nights_per_rent_duration, {floored('b.booked_from')} AS nights_spent,
  {fb('price')} AS price, {fb('beds')} AS beds, {fb('city')} AS city, {fb('accommodates')} AS accommodates,
  {fb('rooms')} AS rooms, {fb('area')} AS area, {fb('next_available_date')} AS next_available_date,
  {fb('created_at')} AS listing_created_at, {fb('has_requests')} AS has_requests,
  CASE lower(p.pets_allowed) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS pets_allowed, b.number_of_tenants AS prd_number_of_tenants
FROM bookings b
LEFT JOIN core_listings c ON b.listing_id = c.listing_id
LEFT JOIN listings r ON r.listing_id = b.listing_id
LEFT JOIN {PAIRS} p ON r.listing_id = p.listing_id
LEFT JOIN landlords ll ON ll.landlord_id = b.landlord_id""")


def _a2() -> str:
    cols = staged_cols(with_raw_extra=False)
    names = ", ".join(c.split(" AS ")[-1].strip() for c in cols)
    return w(f"""SELECT {names}, string_agg(te_city, ',' ORDER BY te_city) AS city
FROM (SELECT {', '.join(cols)}, te_city FROM te_city_rows WHERE pipeline_id = 1) GROUP BY ALL""")


SQL["j8"] = _j8()
SQL["a2"] = _a2()
for _name, (_mart, _cols) in MART_RULES.items():
    SQL[_name] = f"SELECT {', '.join(_cols)} FROM ({MART_SQL[_mart]()})"
for _name, _fn in MART_SQL.items():
    SQL[_name] = _fn()


def oracle_queries() -> dict[str, str]:
    return dict(SQL)
