"""Domain inputs derived from the driver's TPC-H-like tables.

The marts consume a CRM deal table and the product's own tables. The test
driver ships TPC-H-like tables instead, so this module derives each domain
input from them with integer arithmetic and string concatenation only, which
an independent SQL engine can reproduce exactly (see ``oracles/adapter.py``).
Every derived table grows with its driver table: deals and listing requests
with ``orders``, bookings with ``lineitem``, listings with ``part``, landlords
with ``supplier``, users and tenants with ``customer``.

Every driver row becomes a row of its table. Where the marts need keys that only
partly overlap (listings in one catalogue, tenants without a user), the other rows
get keys shifted out of the common range by ``SHIFT`` instead of being left out.

Nothing here shuffles except the bookings table, which numbers the ``lineitem`` rows
of equal (l_orderkey, l_linenumber) so that ``booking_id`` is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from .schemas import EMAIL_ARRAY, PERSON

# Adapter vocabulary (synthetic; cities and free-text answers used to fill the
# CRM columns). The pools end with NULL so missing answers are exercised too.
CITIES = ["Berlin", "Hamburg", "München", "Köln", "Frankfurt", "Stuttgart",
          "Düsseldorf", "Leipzig", "Dortmund", "Essen", "Bremen", "Dresden"]
DURATION_POOL = [a for row in L.MAX_RENT_DURATION for a in row[0]] + ["Two weeks", None]
RENT_POOL = [a for row in L.RENT_PER_PERSON for a in row[0]] + ["200 Euro", None]
PETS_POOL = [a for row in L.PETS_POSSIBLE for a in row[0]] + ["Only cats", None]
PETS_TEXT_POOL = ["%no %", "%without", "None%", "no pets", "none at all", "a small dog",
                  "without animals", "i don't have any", "", "cat", "No Cats", "NONE", None]
DISABILITY_TEXT_POOL = ["%no %", "%without", "None%", "no", "nobody", "without", "none needed",
                        "I don't know", "wheelchair", "", "Blind person", None]
NEEDED_POOL = [t for t, _ in L.NEEDED_MONTHS_EQUALS] + [
    "I really dont know", "indefinitely", "A few weeks", "I don't know, indefinite", None]
PRIORITY_REASON = {"1-URGENT": "Duplicate Data", "2-HIGH": "Flawed/Fake Data Entry", "4-NOT SPECIFIED": None}
MAIL_DOMAIN = "@mail.example"
SHIFT = 10_000_000_000  # added to keys that no other table refers to

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(pool: list, idx: Column) -> Column:
    """pool[idx] for a non-negative integer column (0-based)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in pool]), (idx + 1).cast("int"))


def mail(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"), F.lit(MAIL_DOMAIN))


def _days_after(date_col: Column, n: Column) -> Column:
    return F.date_add(date_col, n.cast("int"))


def _ts_from_day(base: str, n: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int")).cast("timestamp_ntz")


def _city_array(m: Column, c1: Column, c2: Column) -> Column:
    none = F.lit(None).cast("string")
    return (F.when(m == 0, F.lit(None).cast("array<string>"))
            .when(m == 1, F.array().cast("array<string>"))
            .when(m == 2, F.array(c1))
            .when(m == 3, F.array(c1, c2))
            .when(m == 4, F.array(c1, none))
            .otherwise(F.array(c2, c1)))


def crm_deals(orders: DataFrame) -> DataFrame:
    """One CRM deal per order; nested person e-mails and city arrays."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    status = (F.when(F.col("o_orderstatus") == "F", F.lit(L.STATUS_WON))
              .when(F.col("o_orderstatus") == "O", F.lit(L.STATUS_LOST))
              .otherwise(F.lit(L.STATUS_OPEN)))
    reason = F.col("o_orderpriority")
    for prio, text in PRIORITY_REASON.items():
        reason = F.when(F.col("o_orderpriority") == prio, F.lit(text).cast("string")).otherwise(reason)

    def elem(value: Column, primary: bool) -> Column:
        return F.struct(value.alias("value"), F.lit(primary).alias("primary"))

    e = k % 20
    user, alt, old = mail("user", c), mail("alt", c), mail("old", c)
    emails = (F.when(e == 1, F.lit(None).cast(EMAIL_ARRAY))
              .when(e == 2, F.array().cast(EMAIL_ARRAY))
              .when(e == 3, F.array(elem(user, False)))
              .when(e == 4, F.array(elem(user, True), elem(alt, True)))
              .when(e == 5, F.array(elem(user, True), elem(user, True)))
              .when(e == 6, F.array(elem(F.lit(None).cast("string"), True)))
              .otherwise(F.array(elem(old, False), elem(user, True))))
    person = F.when(e == 0, F.lit(None).cast(PERSON)).otherwise(F.struct(emails.alias("email")))

    ts = F.col("o_orderdate")
    return orders.select(
        k.alias("id"),
        (F.lit(1) + k % 2).cast("long").alias("pipeline_id"),
        F.concat(F.lit("Deal "), k.cast("string")).alias("title"),
        F.concat(F.lit("Person "), c.cast("string")).alias("person_name"),
        person.alias("person_id"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(pick(CITIES, c % 12)).alias("ll_cities"),
        _city_array(k % 6, pick(CITIES, c % 12), pick(CITIES, (c + k) % 12)).alias("ll_cities_cleaned"),
        _city_array((k + c) % 6, pick(CITIES, (c + 5) % 12), pick(CITIES, k % 12)).alias("te_cities_cleaned"),
        (k % 13 == 0).alias("deleted"),
        F.concat(F.lit("Owner "), (k % 7).cast("string")).alias("owner_name"),
        F.concat(F.lit("deal"), k.cast("string"), F.lit("@crm.example")).alias("cc_email"),
        ts.alias("add_time"),
        ts.alias("update_time"),
        ts.alias("stage_change_time"),
        status.alias("status"),
        F.when(status != L.STATUS_OPEN, ts).alias("close_time"),
        F.when(status == L.STATUS_WON, ts).alias("won_time"),
        F.when(status == L.STATUS_WON, ts).alias("first_won_time"),
        F.when(status == L.STATUS_LOST, ts).alias("lost_time"),
        reason.alias("lost_reason"),
        pick(DURATION_POOL, (k + c) % len(DURATION_POOL)).alias("_ll_maximum_rent_duration_possible_"),
        pick(RENT_POOL, (k * 3 + c) % len(RENT_POOL)).alias("_ll_rent_per_person_"),
        pick(PETS_POOL, (k + c * 2) % len(PETS_POOL)).alias("_ll_pets_possible_"),
        F.to_date(ts).alias("te_move_in_date"),
        F.col("o_orderpriority").alias("te_priority"),
        pick(PETS_TEXT_POOL, (k + c) % len(PETS_TEXT_POOL)).alias("te_pets_cleaned"),
        pick(DISABILITY_TEXT_POOL, (k * 7 + c) % len(DISABILITY_TEXT_POOL)).alias(
            "te_disabled_help_needed_people_cleaned"),
        (k % 4).cast("long").alias("_ll_amount_rental_units_"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(k % 6).cast("long").alias("_ll_beds_available_in_total_"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(c % 5).cast("long").alias("ll_slots_available_edit_team_1"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(1 + k % 5).cast("long").alias(
            "te_number_of_people_in_the_group_keep_updated"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(k % 3).cast("long").alias("te_number_of_children_under_18_"),
        pick(NEEDED_POOL, (k + c * 3) % len(NEEDED_POOL)).alias("_te_needed_months_to_rent_"),
    )


def shifted(key: Column, away: Column) -> Column:
    """The key as text, moved out of the common range where ``away`` holds."""
    return F.when(away, key + F.lit(SHIFT)).otherwise(key.cast("long")).cast("string")


def program_listings(part: DataFrame) -> DataFrame:
    """Program listings: one per part; every fifth has an id that no booking refers to."""
    p, size = F.col("p_partkey"), F.col("p_size")
    nullflag = p % 13 == 0
    odd_price = (F.when(p % 97 == 0, F.lit(12345678.5)).when(p % 89 == 0, F.lit(0.0001)).when(p % 83 == 0, F.lit(1e15)))
    return part.select(
        shifted(p, p % 5 == 0).alias("listing_id"),
        F.when(p % 29 == 0, F.lit(None).cast("string")).otherwise(F.expr("CAST(p_partkey div 17 AS STRING)")).alias(
            "landlord_id"),
        F.when(p % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("city"),
        F.when(nullflag, F.lit(None)).otherwise(size % 2 == 0).cast("boolean").alias("is_bookable"),
        F.when(nullflag, F.lit(None)).otherwise(size % 3 == 0).cast("boolean").alias("is_online"),
        (p % 4 != 1).alias("is_published"),
        (p % 10 == 3).alias("is_deleted"),
        (size % 5 == 0).alias("has_requests"),
        _ts_from_day("1995-01-01", p % 1000).alias("created_at"),
        _ts_from_day("1995-01-31", p % 1000).alias("available_from"),
        F.when(p % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            _ts_from_day("1996-02-05", p % 1000)).alias("available_to"),
        F.when(nullflag, F.lit(None)).otherwise(size % 7).cast("long").alias("beds"),
        F.when(p % 23 == 0, F.lit(None).cast("double")).otherwise(
            F.coalesce(odd_price, F.round((F.col("p_retailprice") - 900) * 10) - 50)).alias("price"),
        (1 + size % 4).cast("long").alias("rooms"),
        (size % 9).cast("long").alias("accommodates"),
        (size * 2.5).cast("double").alias("area"),
        F.date_add(F.lit("1995-03-02").cast("date"), (p % 1000).cast("int")).alias("next_available_date"),
    )


def core_listings(part: DataFrame) -> DataFrame:
    """All-platform ('core') listings: one per part, other values; every fourth in this catalogue only."""
    p, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        shifted(p, p % 4 == 0).alias("listing_id"),
        F.expr("CAST(p_partkey div 17 AS STRING)").alias("landlord_id"),
        F.concat(F.lit("core "), F.col("p_type")).alias("city"),
        (size % 2 == 1).alias("is_bookable"),
        F.lit(True).alias("is_online"),
        (size > 10).alias("is_published"),
        F.lit(False).alias("is_deleted"),
        (size % 3 == 0).alias("has_requests"),
        _ts_from_day("1994-06-01", p % 700).alias("created_at"),
        _ts_from_day("1994-07-01", p % 700).alias("available_from"),
        _ts_from_day("1995-07-01", p % 700).alias("available_to"),
        (size % 5).cast("long").alias("beds"),
        F.round(F.col("p_retailprice") - 900).alias("price"),
        (1 + size % 3).cast("long").alias("rooms"),
        (size % 6).cast("long").alias("accommodates"),
        (size * 3.0).cast("double").alias("area"),
        F.date_add(F.lit("1994-08-01").cast("date"), (p % 700).cast("int")).alias("next_available_date"),
    )


def landlords(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    return supplier.select(
        shifted(s, s % 7 == 3).alias("landlord_id"),  # bookings of these suppliers find no landlord
        F.when(s % 10 == 0, F.lit(None).cast("string")).otherwise(mail("user", s)).alias("freshworks_email"),
    )


def users(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.select(
        shifted(c, c % 2 != 0).alias("user_id"),
        F.when(c % 50 == 0, F.lit(None).cast("string")).otherwise(mail("user", c)).alias("email"),
    )


def tenants(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.select(shifted(c, c % 3 == 0).alias("tenant_id"))


def bookings(lineitem: DataFrame) -> DataFrame:
    """One booking per line item. (l_orderkey, l_linenumber) is not unique in the driver
    table, so equal pairs (a handful of rows) are numbered by the columns that are used."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    g = lineitem.select(k, ln, F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
                        F.col("l_shipdate").alias("shipdate"))
    g = g.withColumn("nth", F.row_number().over(
        Window.partitionBy("l_orderkey", "l_linenumber").orderBy("partkey", "suppkey", "shipdate")))
    booked_from = F.to_date("shipdate")
    return g.select(
        F.concat_ws("-", k.cast("string"), ln.cast("string"), F.col("nth").cast("string")).alias("booking_id"),
        F.col("suppkey").cast("string").alias("landlord_id"),
        F.expr("CAST(l_orderkey div 10 AS STRING)").alias("tenant_id"),
        F.col("partkey").cast("string").alias("listing_id"),
        F.col("shipdate").alias("actual_booking_created_at"),
        booked_from.alias("booked_from"),
        F.when(k % 31 == 0, F.lit(None).cast("date")).otherwise(
            _days_after(booked_from, (k * 7 + ln * 13) % 200)).alias("booked_to"),
        (k % 8 == 0).alias("is_canceled"),
        (1 + (k + ln) % 4).cast("long").alias("number_of_tenants"),
    )


def booking_parts(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``bookings`` in two parts: rows whose id no other row has, whatever the table holds, and the others.

    An id of three numbers names one order, line and place among their rows. Where order or line is NULL, the id
    has fewer numbers and may be that of other such rows ("3-1": order 3 or line 3), never one of three."""
    named = F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
    return bookings(lineitem.where(named)), bookings(lineitem.where(~named))


def listing_requests(orders: DataFrame) -> DataFrame:
    """Listing requests: one per order."""
    k = F.col("o_orderkey")
    req_from = F.date_add(F.to_date("o_orderdate"), 14)
    adults_ = (1 + k % 3).cast("long")
    children_ = F.when(k % 7 == 0, F.lit(None)).otherwise(k % 2).cast("long")
    pets = pick(["true", "false", None, "yes", "1", "TRUE", "no", "False"], F.expr("(o_orderkey div 3) % 8"))
    return orders.select(
        F.concat(F.lit("lr"), k.cast("string")).alias("listing_request_id"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.expr("CAST(o_orderkey div 8 AS STRING)")).alias(
            "listing_id"),
        F.col("o_custkey").cast("string").alias("tenant_id"),
        F.col("o_orderdate").alias("created_at"),
        req_from.alias("requested_from"),
        F.when(k % 41 == 0, F.lit(None).cast("date")).otherwise(_days_after(req_from, k % 200)).alias("requested_to"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("Brand#"), (k % 25).cast("string"))).alias("listing_city"),
        F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise(F.round(F.col("o_totalprice") / 500)).alias(
            "listing_price"),
        (F.when(F.col("o_orderstatus") == "F", F.lit("Won")).when(F.col("o_orderstatus") == "O", F.lit("Lost"))
         .otherwise(F.lit("Open"))).alias("deal_status"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("status_reason"),
        adults_.alias("adults"),
        children_.alias("children"),
        (adults_ + F.coalesce(children_, F.lit(0).cast("long"))).alias("number_of_tenants"),
        F.when(k % 5 == 0, F.lit(None).cast("boolean")).otherwise(k % 2 == 0).alias("tenant_has_pets"),
        pets.alias("pets_allowed"),
    )


def domain_sources(spark: SparkSession, sf_dir: str):
    """Bind the logical source names to DataFrames derived from ``sf_dir``."""
    from .catalog import Sources
    orders = read_driver(spark, sf_dir, "orders")
    part = read_driver(spark, sf_dir, "part")
    customer = read_driver(spark, sf_dir, "customer")
    lineitem = read_driver(spark, sf_dir, "lineitem")
    return Sources(
        deals=crm_deals(orders),
        bookings=bookings(lineitem),
        listings=program_listings(part),
        core_listings=core_listings(part),
        listing_requests=listing_requests(orders),
        landlords=landlords(read_driver(spark, sf_dir, "supplier")),
        users=users(customer),
        tenants=tenants(customer),
        booking_parts=booking_parts(lineitem),
    )
