"""DuckDB twin of ``recomart.sources.adapter``: the domain inputs as SQL CTEs.

The nested CRM columns are not rebuilt as arrays here. Instead the oracle
writes the *flat* result of each unnest directly (one row per primary e-mail,
one row per city element) from the same integer rules, so the Spark explode
logic is checked against an independent formulation.
"""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "labels.json"), encoding="utf-8") as _f:
    #: The labels of the CRM forms as fixed values, stated apart from the package.
    LABELS = SimpleNamespace(**json.load(_f))

#: The adapter's vocabulary, restated: fixed values and their order.
A = SimpleNamespace(
    CITIES=["Berlin", "Hamburg", "München", "Köln", "Frankfurt", "Stuttgart",
            "Düsseldorf", "Leipzig", "Dortmund", "Essen", "Bremen", "Dresden"],
    DURATION_POOL=[a for row in LABELS.MAX_RENT_DURATION for a in row[0]] + ["Two weeks", None],
    RENT_POOL=[a for row in LABELS.RENT_PER_PERSON for a in row[0]] + ["200 Euro", None],
    PETS_POOL=[a for row in LABELS.PETS_POSSIBLE for a in row[0]] + ["Only cats", None],
    PETS_TEXT_POOL=["%no %", "%without", "None%", "no pets", "none at all", "a small dog",
                    "without animals", "i don't have any", "", "cat", "No Cats", "NONE", None],
    DISABILITY_TEXT_POOL=["%no %", "%without", "None%", "no", "nobody", "without", "none needed",
                          "I don't know", "wheelchair", "", "Blind person", None],
    NEEDED_POOL=[row[0] for row in LABELS.NEEDED_MONTHS_EQUALS] + [
        "I really dont know", "indefinitely", "A few weeks", "I don't know, indefinite", None],
    PRIORITY_REASON={"1-URGENT": "Duplicate Data", "2-HIGH": "Flawed/Fake Data Entry", "4-NOT SPECIFIED": None},
    MAIL_DOMAIN="@mail.example")

AS_OF = "2000-06-30"


def q(s: str | None) -> str:
    """SQL literal for a Python string (None -> NULL)."""
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def qlist(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def pick(values, idx_sql: str) -> str:
    return f"({qlist(values)})[({idx_sql}) + 1]"


def mail(prefix: str, key_sql: str) -> str:
    return f"'{prefix}' || CAST({key_sql} AS VARCHAR) || '{A.MAIL_DOMAIN}'"


def adapter_ctes() -> str:
    C = A.CITIES
    reason = "o_orderpriority"
    reason_case = "CASE o_orderpriority " + " ".join(
        f"WHEN {q(p)} THEN {q(t)}" for p, t in A.PRIORITY_REASON.items()) + f" ELSE {reason} END"
    return f"""
deal_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS ts, o_orderpriority,
         CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'lost' ELSE 'open' END AS status
  FROM orders
),
deals AS (
  SELECT
    k AS id, CAST(1 + k % 2 AS BIGINT) AS pipeline_id,
    'Deal ' || CAST(k AS VARCHAR) AS title, 'Person ' || CAST(c AS VARCHAR) AS person_name,
    k % 20 AS e_mode, c AS cust,
    CASE WHEN k % 17 = 0 THEN NULL ELSE {pick(C, 'c % 12')} END AS ll_cities,
    k % 6 AS ll_mode, {pick(C, 'c % 12')} AS ll_c1, {pick(C, '(c + k) % 12')} AS ll_c2,
    (k + c) % 6 AS te_mode, {pick(C, '(c + 5) % 12')} AS te_c1, {pick(C, 'k % 12')} AS te_c2,
    k % 13 = 0 AS deleted,
    'Owner ' || CAST(k % 7 AS VARCHAR) AS owner_name,
    'deal' || CAST(k AS VARCHAR) || '@crm.example' AS cc_email,
    ts AS add_time, ts AS update_time, ts AS stage_change_time, status,
    CASE WHEN status <> 'open' THEN ts END AS close_time,
    CASE WHEN status = 'won' THEN ts END AS won_time,
    CASE WHEN status = 'won' THEN ts END AS first_won_time,
    CASE WHEN status = 'lost' THEN ts END AS lost_time,
    {reason_case} AS lost_reason,
    {pick(A.DURATION_POOL, f'(k + c) % {len(A.DURATION_POOL)}')} AS _ll_maximum_rent_duration_possible_,
    {pick(A.RENT_POOL, f'(k * 3 + c) % {len(A.RENT_POOL)}')} AS _ll_rent_per_person_,
    {pick(A.PETS_POOL, f'(k + c * 2) % {len(A.PETS_POOL)}')} AS _ll_pets_possible_,
    CAST(ts AS DATE) AS te_move_in_date, o_orderpriority AS te_priority,
    {pick(A.PETS_TEXT_POOL, f'(k + c) % {len(A.PETS_TEXT_POOL)}')} AS te_pets_cleaned,
    {pick(A.DISABILITY_TEXT_POOL, f'(k * 7 + c) % {len(A.DISABILITY_TEXT_POOL)}')}
        AS te_disabled_help_needed_people_cleaned,
    CAST(k % 4 AS BIGINT) AS _ll_amount_rental_units_,
    CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k % 6 AS BIGINT) END AS _ll_beds_available_in_total_,
    CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(c % 5 AS BIGINT) END AS ll_slots_available_edit_team_1,
    CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(1 + k % 5 AS BIGINT) END
        AS te_number_of_people_in_the_group_keep_updated,
    CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(k % 3 AS BIGINT) END AS te_number_of_children_under_18_,
    {pick(A.NEEDED_POOL, f'(k + c * 3) % {len(A.NEEDED_POOL)}')} AS _te_needed_months_to_rent_
  FROM deal_base
),
deal_emails AS (
  SELECT d.*, {mail('user', 'cust')} AS email FROM deals d WHERE e_mode NOT IN (0, 1, 2, 3, 6)
  UNION ALL SELECT d.*, {mail('alt', 'cust')} FROM deals d WHERE e_mode = 4
  UNION ALL SELECT d.*, {mail('user', 'cust')} FROM deals d WHERE e_mode = 5
  UNION ALL SELECT d.*, CAST(NULL AS VARCHAR) FROM deals d WHERE e_mode = 6
),
ll_city_rows AS (
  SELECT de.*, 0 AS city_pos,
         CASE WHEN ll_mode IN (0, 1) THEN NULL WHEN ll_mode = 5 THEN ll_c2 ELSE ll_c1 END AS city_elem
  FROM deal_emails de
  UNION ALL
  SELECT de.*, 1, CASE ll_mode WHEN 3 THEN ll_c2 WHEN 5 THEN ll_c1 END
  FROM deal_emails de WHERE ll_mode IN (3, 4, 5)
),
te_city_rows AS (
  SELECT de.*, CASE WHEN te_mode IN (0, 1) THEN NULL WHEN te_mode = 5 THEN te_c2 ELSE te_c1 END AS te_city
  FROM deal_emails de
  UNION ALL
  SELECT de.*, CASE te_mode WHEN 3 THEN te_c2 WHEN 5 THEN te_c1 END
  FROM deal_emails de WHERE te_mode IN (3, 4, 5)
),
bk_pairs AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS partkey, l_suppkey AS suppkey, l_shipdate AS shipdate,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS nth
  FROM lineitem
),
bookings AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(nth AS VARCHAR) AS booking_id,
         CAST(suppkey AS VARCHAR) AS landlord_id,
         CAST(l_orderkey // 10 AS VARCHAR) AS tenant_id,
         CAST(partkey AS VARCHAR) AS listing_id,
         shipdate AS actual_booking_created_at,
         CAST(shipdate AS DATE) AS booked_from,
         CASE WHEN l_orderkey % 31 = 0 THEN NULL
              ELSE CAST(shipdate AS DATE) + CAST((l_orderkey * 7 + l_linenumber * 13) % 200 AS INTEGER) END
           AS booked_to,
         l_orderkey % 8 = 0 AS is_canceled,
         CAST(1 + (l_orderkey + l_linenumber) % 4 AS BIGINT) AS number_of_tenants
  FROM bk_pairs
),
listings AS (
  SELECT CAST(p_partkey + CASE WHEN p_partkey % 5 = 0 THEN 10000000000 ELSE 0 END AS VARCHAR) AS listing_id,
         CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_partkey // 17 AS VARCHAR) END AS landlord_id,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS city,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 2 = 0 END AS is_bookable,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 3 = 0 END AS is_online,
         p_partkey % 4 <> 1 AS is_published, p_partkey % 10 = 3 AS is_deleted, p_size % 5 = 0 AS has_requests,
         CAST(DATE '1995-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '1995-01-31' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) AS available_from,
         CASE WHEN p_partkey % 3 = 0 THEN NULL
              ELSE CAST(DATE '1996-02-05' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) END AS available_to,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size % 7 AS BIGINT) END AS beds,
         CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN 12345678.5::DOUBLE
              WHEN p_partkey % 89 = 0 THEN 0.0001::DOUBLE WHEN p_partkey % 83 = 0 THEN 1e15::DOUBLE
              ELSE round((p_retailprice - 900) * 10) - 50 END AS price,
         CAST(1 + p_size % 4 AS BIGINT) AS rooms, CAST(p_size % 9 AS BIGINT) AS accommodates,
         CAST(p_size * 2.5 AS DOUBLE) AS area,
         DATE '1995-03-02' + CAST(p_partkey % 1000 AS INTEGER) AS next_available_date
  FROM part
),
core_listings AS (
  SELECT CAST(p_partkey + CASE WHEN p_partkey % 4 = 0 THEN 10000000000 ELSE 0 END AS VARCHAR) AS listing_id, CAST(p_partkey // 17 AS VARCHAR) AS landlord_id,
         'core ' || p_type AS city, p_size % 2 = 1 AS is_bookable, TRUE AS is_online,
         p_size > 10 AS is_published, FALSE AS is_deleted, p_size % 3 = 0 AS has_requests,
         CAST(DATE '1994-06-01' + CAST(p_partkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '1994-07-01' + CAST(p_partkey % 700 AS INTEGER) AS TIMESTAMP) AS available_from,
         CAST(DATE '1995-07-01' + CAST(p_partkey % 700 AS INTEGER) AS TIMESTAMP) AS available_to,
         CAST(p_size % 5 AS BIGINT) AS beds, round(p_retailprice - 900) AS price,
         CAST(1 + p_size % 3 AS BIGINT) AS rooms, CAST(p_size % 6 AS BIGINT) AS accommodates,
         CAST(p_size * 3.0 AS DOUBLE) AS area,
         DATE '1994-08-01' + CAST(p_partkey % 700 AS INTEGER) AS next_available_date
  FROM part
),
landlords AS (
  SELECT CAST(s_suppkey + CASE WHEN s_suppkey % 7 = 3 THEN 10000000000 ELSE 0 END AS VARCHAR) AS landlord_id,
         CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE {mail('user', 's_suppkey')} END AS freshworks_email
  FROM supplier
),
users AS (
  SELECT CAST(c_custkey + CASE WHEN c_custkey % 2 <> 0 THEN 10000000000 ELSE 0 END AS VARCHAR) AS user_id,
         CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE {mail('user', 'c_custkey')} END AS email
  FROM customer
),
tenants AS (
  SELECT CAST(c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 10000000000 ELSE 0 END AS VARCHAR) AS tenant_id FROM customer
),
listing_requests AS (
  SELECT 'lr' || CAST(o_orderkey AS VARCHAR) AS listing_request_id,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey // 8 AS VARCHAR) END AS listing_id,
         CAST(o_custkey AS VARCHAR) AS tenant_id,
         o_orderdate AS created_at,
         CAST(o_orderdate AS DATE) + 14 AS requested_from,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL
              ELSE CAST(o_orderdate AS DATE) + 14 + CAST(o_orderkey % 200 AS INTEGER) END AS requested_to,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Brand#' || CAST(o_orderkey % 25 AS VARCHAR) END
           AS listing_city,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE round(o_totalprice / 500) END AS listing_price,
         CASE o_orderstatus WHEN 'F' THEN 'Won' WHEN 'O' THEN 'Lost' ELSE 'Open' END AS deal_status,
         CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS status_reason,
         CAST(1 + o_orderkey % 3 AS BIGINT) AS adults,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS BIGINT) END AS children,
         CAST(1 + o_orderkey % 3 + CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 2 END AS BIGINT)
           AS number_of_tenants,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS tenant_has_pets,
         ['true', 'false', NULL, 'yes', '1', 'TRUE', 'no', 'False'][(o_orderkey // 3) % 8 + 1] AS pets_allowed
  FROM orders
)"""
