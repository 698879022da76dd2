"""One query per inventory ID (sources, predicates, joins, aggregates, functions,
business rules), each over the domain inputs derived from the driver tables.

Row-wise rules run on the staged CRM or product rows; the reconciliation rules
(D19-D35) are read off the mart that uses them, so each is checked in context.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import labels as L
from ..operators.aggregate import distinct_pairs, string_agg
from ..operators.reconcile import full_outer_reconcile
from ..operators.union import union_positional
from ..operators.unnest import explode_keep_empty, explode_primary, primary_elements
from ..sources.adapter import domain_sources
from ..sources.catalog import Sources
from ..sources.versions import publish_version
from . import marts as M
from .deals import DealRules, crm_filter, stage_deals, with_needed_months
from .product import enriched_bookings

AS_OF = "2000-06-30"
Query = Callable[[SparkSession, str], DataFrame]

# cached per session (dropped with it) and sf_dir so building many queries does not re-plan the adapter
_SRC: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    cached = _SRC.setdefault(spark, {})
    if sf_dir not in cached:
        cached[sf_dir] = domain_sources(spark, sf_dir)
    return cached[sf_dir]


def _deals(spark, sf):
    return sources(spark, sf).deals


def _won_landlord_deals(s: Sources) -> DataFrame:
    return crm_filter(stage_deals(s.deals, DealRules(), AS_OF, pipeline=L.LANDLORD_PIPELINE),
                      L.LANDLORD_PIPELINE, L.STATUS_WON)


def _landlord_bookings(s: Sources) -> DataFrame:
    ll = s.landlords.select(F.col("landlord_id").alias("l_id"), "freshworks_email")
    return s.bookings.join(ll, F.col("landlord_id") == F.col("l_id"), "left").drop("l_id")


# ----------------------------------------------------------------------------- S
def s1(spark, sf):
    d = _deals(spark, sf)
    arr = F.col("person_id.email")
    return d.select("id", "pipeline_id", "status",
                    F.when(arr.isNull(), None).otherwise(F.size(arr)).cast("long").alias("n_emails"),
                    F.when(F.col("ll_cities_cleaned").isNull(), None)
                    .otherwise(F.size("ll_cities_cleaned")).cast("long").alias("n_cities"))


def s2(spark, sf):
    return sources(spark, sf).bookings


def s3(spark, sf):
    return sources(spark, sf).listings


def s4(spark, sf):
    return sources(spark, sf).core_listings


def s5(spark, sf):
    return sources(spark, sf).listing_requests


def s6(spark, sf):
    s = sources(spark, sf)
    return union_positional(
        s.landlords.select(F.lit("landlord").alias("kind"), F.col("landlord_id").alias("dim_id"),
                           F.col("freshworks_email").alias("email")),
        s.users.select(F.lit("user"), "user_id", "email"),
        s.tenants.select(F.lit("tenant"), "tenant_id", F.lit(None).cast("string")))


def s7(spark, sf):
    """Logical names bound as views; the same SQL text runs on any binding."""
    src, prefix = sources(spark, sf), f"rm_{uuid.uuid4().hex}_"
    names = src.register(prefix=prefix)
    found = spark.sql("SELECT listing_id, count(*) AS n_bookings, min(booked_from) AS first_booked_from "
                      f"FROM {prefix}bookings GROUP BY listing_id")
    for name in names:  # the query is resolved; the caller's session keeps no views
        spark.catalog.dropTempView(name)
    return found


def s8(spark, sf):
    """Publish a mart under its name in the warehouse, as the next version, and read it back by name."""
    return publish_version(M.listing_union_mart(sources(spark, sf), AS_OF), "landlord_listings")


# ----------------------------------------------------------------------------- P
def p1(spark, sf):
    return sources(spark, sf).bookings.select(
        F.col("booking_id").alias("prd_bookingid"), F.col("booked_from").alias("prd_booked_from"),
        F.col("booked_to").alias("prd_booked_to"), F.col("listing_id").alias("prd_listing_id"))


def p2(spark, sf):
    return sources(spark, sf).landlords.select("*")


def p3(spark, sf):
    s = sources(spark, sf)
    pairs = distinct_pairs(s.listing_requests, "listing_id", "pets_allowed").alias("lr")
    return (s.listings.alias("prd").join(pairs, F.col("prd.listing_id") == F.col("lr.listing_id"), "left")
            .select("prd.*", "lr.pets_allowed"))


def p4(spark, sf):
    return sources(spark, sf).listing_requests.withColumn(
        "rent_duration", X.days_between("requested_to", "requested_from"))


def p5(spark, sf):
    return _deals(spark, sf).select(F.lit("Pipedrive").alias("data_source"), "id")


def p6(spark, sf):
    return sources(spark, sf).listings.select(
        "listing_id", F.lit(None).cast("long").alias("pd_total_beds_edit_team1"),
        F.lit(None).cast("string").alias("pd_max_rent_duration"), F.lit(None).cast("boolean").alias("pd_flag"))


def p7(spark, sf):
    first = F.try_element_at(F.col("person_id.email"), F.lit(1))
    return _deals(spark, sf).select("id", first["value"].alias("first_email"),
                                    first["primary"].alias("first_is_primary"))


def p8(spark, sf):
    arr = F.col("person_id.email")
    return _deals(spark, sf).select(
        "id", F.when(arr.isNull(), None).otherwise(F.size(primary_elements(arr))).cast("long").alias("n_primary"))


def p9(spark, sf):
    return _deals(spark, sf).where((F.col("pipeline_id") == L.LANDLORD_PIPELINE) &
                                   (F.col("status") == L.STATUS_WON)).select("id", "title")


def p10(spark, sf):
    reason = F.coalesce(F.col("lost_reason"), F.lit(L.UNDEFINED))
    return _deals(spark, sf).where(~reason.isin(*L.EXCLUDED_LOST_REASONS)).select("id", reason.alias("lost_reason"))


def p11(spark, sf):
    s = sources(spark, sf)
    core = s.core_listings.select(F.col("listing_id").alias("c_id"), F.col("city").alias("core_city"))
    return (s.bookings.join(core, F.col("listing_id") == F.col("c_id"), "left")
            .where(F.col("c_id").isNotNull()).select("booking_id", "core_city"))


def p12(spark, sf):
    s = sources(spark, sf)
    ll = s.landlords.select(F.col("landlord_id").alias("l_id"), "freshworks_email")
    j = s.listings.join(ll, F.col("landlord_id") == F.col("l_id"), "left")
    flag = X.true_or_null(F.col("freshworks_email").isNotNull())
    return j.where(flag.isNull()).select("listing_id", "landlord_id")


def p13(spark, sf):
    col = F.col("_ll_maximum_rent_duration_possible_")
    answers = [a for row in L.MAX_RENT_DURATION for a in row[0]]
    return _deals(spark, sf).where(col.isin(*answers)).select("id", col.alias("answer"))


def p14(spark, sf):
    col = F.col("te_pets_cleaned")
    return _deals(spark, sf).where(col.isin(*L.LITERAL_NO_ANSWERS)).select("id", col.alias("answer"))


def p15(spark, sf):
    low = F.lower("te_pets_cleaned")
    return _deals(spark, sf).select("id", low.like("%no%").alias("contains_no"),
                                    low.like("none%").alias("starts_none"),
                                    low.like("%without").alias("ends_without"),
                                    low.contains("without").alias("contains_without"))


def p16(spark, sf):
    c = F.col("_te_needed_months_to_rent_")
    return _deals(spark, sf).select(
        "id", F.when(c.like("%know%"), F.lit("Unknown")).when(c.like("%indef%"), F.lit(">6 mo")).alias("like_class"))


def p17(spark, sf):
    n = X.days_between("booked_to", "booked_from")
    return sources(spark, sf).bookings.select(
        "booking_id", n.alias("nights"), X.stay_class(F.lit(None).cast("string"), n).alias("bucket"))


def p18(spark, sf):
    return sources(spark, sf).listings.select(
        "listing_id", (F.col("is_bookable") & F.col("is_online")).alias("both_flags"),
        (F.col("is_bookable") | F.col("is_online")).alias("any_flag"), F.col("city").isNull().alias("no_city"),
        (F.col("city").isNotNull() & F.col("price").isNull()).alias("city_without_price"))


def p19(spark, sf):
    return sources(spark, sf).listings.select(
        "listing_id", F.col("is_bookable").eqNullSafe(True).alias("bookable_is_true"),
        (~F.col("is_online").eqNullSafe(True)).alias("online_is_not_true"))


def p20(spark, sf):
    return _deals(spark, sf).select("id", "te_priority", F.col("te_priority").alias("deal_priority"))


# ----------------------------------------------------------------------------- J
def j1(spark, sf):
    return explode_primary(_deals(spark, sf)).select("id", "email")


def j2(spark, sf):
    rows = explode_keep_empty(explode_primary(_deals(spark, sf)), "ll_cities_cleaned", "city")
    return rows.select("id", "email", "city")


def j3(spark, sf):
    rows = explode_keep_empty(explode_primary(_deals(spark, sf)), "ll_cities_cleaned", "city", with_offset="pos")
    return rows.select("id", "email", F.col("pos").cast("long").alias("pos"), "city")


def j4(spark, sf):
    """Skew-safe full join: inner join plus both anti joins."""
    s = sources(spark, sf)
    left = _won_landlord_deals(s).select(F.col("id").alias("pd_id"), F.col("email").alias("pd_email"))
    right = _landlord_bookings(s).select(F.col("booking_id").alias("prd_booking_id"),
                                         F.col("freshworks_email").alias("prd_email"))
    return full_outer_reconcile(left, right, "pd_email", "prd_email")


def j5a(spark, sf):
    s = sources(spark, sf)
    core = s.core_listings.select(F.col("listing_id").alias("c_id"), F.col("city").alias("core_city"),
                                  F.col("price").alias("core_price"))
    return s.bookings.join(core, F.col("listing_id") == F.col("c_id"), "left").select(
        "booking_id", "core_city", "core_price")


def j5b(spark, sf):
    s = sources(spark, sf)
    core = s.core_listings.select(F.col("listing_id").alias("c_id"), F.col("price").alias("core_price"))
    core_bk = s.bookings.select(F.col("booking_id").alias("cb_id"), F.col("listing_id").alias("cb_lid")).join(
        core, F.col("cb_lid") == F.col("c_id"), "inner")
    return s.bookings.join(core_bk, F.col("booking_id") == F.col("cb_id"), "left").select("booking_id", "core_price")


def j5c(spark, sf):
    s = sources(spark, sf)
    rfg = s.listings.select(F.col("listing_id").alias("r_id"), F.col("city").alias("rfg_city"),
                            F.col("price").alias("rfg_price"))
    return s.bookings.join(rfg, F.col("listing_id") == F.col("r_id"), "left").select(
        "booking_id", "rfg_city", "rfg_price")


def j5d(spark, sf):
    s = sources(spark, sf)
    pairs = distinct_pairs(s.listing_requests, "listing_id", "pets_allowed").select(
        F.col("listing_id").alias("p_id"), "pets_allowed")
    return s.listings.join(pairs, F.col("listing_id") == F.col("p_id"), "left").select("listing_id", "pets_allowed")


def j5e(spark, sf):
    s = sources(spark, sf)
    ll = s.landlords.select(F.col("landlord_id").alias("l_id"), "freshworks_email")
    return s.listings.join(ll, F.col("landlord_id") == F.col("l_id"), "left").select("listing_id", "freshworks_email")


def j5f(spark, sf):
    s = sources(spark, sf)
    return s.bookings.join(s.users, F.col("tenant_id") == F.col("user_id"), "left").select("booking_id", "email")


def j5g(spark, sf):
    s = sources(spark, sf)
    te = s.tenants.select(F.col("tenant_id").alias("t_tenant_id"))
    return s.listing_requests.join(te, F.col("tenant_id") == F.col("t_tenant_id"), "left").select(
        "listing_request_id", "t_tenant_id")


def j5h(spark, sf):
    s = sources(spark, sf)
    ls = s.listings.select(F.col("listing_id").alias("l_id"), F.col("is_online").alias("ls_is_online"),
                           F.col("beds").alias("ls_beds"))
    return s.listing_requests.join(ls, F.col("listing_id") == F.col("l_id"), "left").select(
        "listing_request_id", "ls_is_online", "ls_beds")


def j5i(spark, sf):
    s = sources(spark, sf)
    core = s.core_listings.select(F.col("listing_id").alias("c_id"), F.col("city").alias("core_city"))
    core_bk = s.bookings.select(F.col("booking_id").alias("cb_id"), F.col("listing_id").alias("cb_lid")).join(
        core, F.col("cb_lid") == F.col("c_id"), "left")
    return core_bk.join(s.bookings, F.col("cb_id") == F.col("booking_id"), "left").select(
        "booking_id", "listing_id", "core_city")


def j5j(spark, sf):
    s = sources(spark, sf)
    d = _won_landlord_deals(s).select("id", "email")
    return d.join(s.landlords, F.col("email") == F.col("freshworks_email"), "left").select("id", "email",
                                                                                          "landlord_id")


def j5k(spark, sf):
    s = sources(spark, sf)
    d = _won_landlord_deals(s).select("id", "email")
    return s.landlords.join(d, F.col("freshworks_email") == F.col("email"), "left").select(
        "landlord_id", "freshworks_email", "id")


def j5r(spark, sf):
    s = sources(spark, sf)
    ll = s.landlords.select(F.col("landlord_id").alias("l_id"), "freshworks_email")
    return ll.join(s.listings, F.col("l_id") == F.col("landlord_id"), "right").select(
        "listing_id", "l_id", "freshworks_email")


def j6(spark, sf):
    s = sources(spark, sf)
    core = s.core_listings.select(F.col("listing_id").alias("c_id"), F.col("price").alias("core_price"))
    return s.bookings.join(core, F.col("listing_id") == F.col("c_id"), "inner").select("booking_id", "core_price")


def j7(spark, sf):
    s = sources(spark, sf)
    ll = s.landlords.select(F.col("landlord_id").alias("l_id"), "freshworks_email")
    prod = s.listings.join(ll, F.col("landlord_id") == F.col("l_id"), "left")
    keys = crm_filter(stage_deals(s.deals, DealRules(), AS_OF, pipeline=L.LANDLORD_PIPELINE),
                      L.LANDLORD_PIPELINE).select(F.col("email").alias("k")).where(F.col("k").isNotNull()).distinct()
    return prod.join(keys, F.col("freshworks_email") == F.col("k"), "left_anti").select("listing_id",
                                                                                       "freshworks_email")


def j8(spark, sf):
    return enriched_bookings(sources(spark, sf), AS_OF, "landlord").drop("pets_allowed_raw", "contact_id")


# ----------------------------------------------------------------------------- A / U
def a1(spark, sf):
    rows = explode_keep_empty(explode_primary(_deals(spark, sf)), "te_cities_cleaned", "te_city")
    return rows.groupBy("id", "email").agg(string_agg("te_city").alias("cities"))


def a2(spark, sf):
    return stage_deals(_deals(spark, sf), DealRules(city="aggregate"), AS_OF, pipeline=L.TENANT_PIPELINE)


def a3(spark, sf):
    return distinct_pairs(sources(spark, sf).listing_requests, "listing_id", "pets_allowed")


def u1(spark, sf):
    s = sources(spark, sf)
    return union_positional(s.landlords.select("landlord_id", "freshworks_email"), s.users.select("user_id", "email"))


# ----------------------------------------------------------------------------- F
def f1(spark, sf):
    return _deals(spark, sf).select("id", F.coalesce("lost_reason", F.lit(L.UNDEFINED)).alias("lost_reason"))


def f2(spark, sf):
    return _deals(spark, sf).select(
        "id", F.when(F.col("deleted"), F.lit("deleted")).otherwise(F.lit("active")).alias("state"))


def f3(spark, sf):
    st = F.col("status")
    return _deals(spark, sf).select("id", F.when(st == "won", F.lit("W")).when(st == "lost", F.lit("L")).alias("s"))


def f4(spark, sf):
    return sources(spark, sf).listing_requests.select(
        "listing_request_id", X.number_text(F.col("listing_price")).alias("price_text"),
        F.col("adults").cast("string").alias("adults_text"))


def f5(spark, sf):
    return sources(spark, sf).listing_requests.select("listing_request_id",
                                                      X.to_bool("pets_allowed").alias("pets_allowed"))


def f6(spark, sf):
    return _deals(spark, sf).select("id", F.to_date("add_time").alias("add_date"),
                                    F.to_date("won_time").alias("won_date"))


def f7(spark, sf):
    return sources(spark, sf).bookings.select("booking_id",
                                              X.days_between("booked_to", "booked_from").alias("nights"))


def f8(spark, sf):
    return _deals(spark, sf).select("id", X.as_of_date(AS_OF).alias("report_date"),
                                    X.days_since("add_time", AS_OF).alias("days_since_added"))


def f9(spark, sf):
    return sources(spark, sf).listings.select("listing_id", F.lower("city").alias("city"))


def f10(spark, sf):
    return _deals(spark, sf).select("id", X.adults("te_number_of_people_in_the_group_keep_updated",
                                                   "te_number_of_children_under_18_").alias("adults"))


# ----------------------------------------------------------------------------- D (row-wise)
def _deal_expr(fn, raw: str, name: str):
    def q(spark, sf):
        return _deals(spark, sf).select("id", F.col(raw).alias("raw"), fn(raw).alias(name))
    return q


DUR, RENT, PETS = "_ll_maximum_rent_duration_possible_", "_ll_rent_per_person_", "_ll_pets_possible_"
PETS_TXT, DIS_TXT = "te_pets_cleaned", "te_disabled_help_needed_people_cleaned"

d1 = _deal_expr(X.rent_duration_class, DUR, "ll_max_rent_duration")
d2 = _deal_expr(X.rent_per_person_class, RENT, "ll_rent_per_person")
d2b = _deal_expr(lambda c: X.rent_per_person_class(c, unsure_as_null=True), RENT, "ll_rent_per_person")
d3 = _deal_expr(X.rent_per_person_number, RENT, "ll_rent_per_person_numeric")
d4 = _deal_expr(X.pets_answer, PETS, "ll_pets_allowed")
d5 = _deal_expr(X.rent_duration_typical_nights, DUR, "nights_per_rent_duration")
d6 = _deal_expr(X.rent_duration_min_nights, DUR, "min_nights_per_rent_duration")
d7 = _deal_expr(X.rent_duration_max_nights, DUR, "max_nights_per_rent_duration")
d8 = _deal_expr(X.pets_bool, PETS, "ll_pets_allowed_bool")
d8b = _deal_expr(X.pets_flag, PETS, "ll_pets_allowed_bool")
d9 = _deal_expr(lambda c: X.has_pets(c, "literal"), PETS_TXT, "te_has_pets")
d9b = _deal_expr(lambda c: X.has_pets(c, "literal", as_int=True), PETS_TXT, "te_has_pets")
d9c = _deal_expr(lambda c: X.has_pets(c, "like_c"), PETS_TXT, "te_has_pets")
d9d = _deal_expr(lambda c: X.has_pets(c, "like_d"), PETS_TXT, "te_has_pets")
d10 = _deal_expr(lambda c: X.has_disability(c, "literal"), DIS_TXT, "te_has_disability")
d10b = _deal_expr(lambda c: X.has_disability(c, "like_b"), DIS_TXT, "te_has_disability")
d10c = _deal_expr(lambda c: X.has_disability(c, "like_c"), DIS_TXT, "te_has_disability")


def d11(spark, sf):
    return _deals(spark, sf).select("id", "status", X.status_onehot("status", L.STATUS_OPEN).alias("open_deal"),
                                    X.status_onehot("status", L.STATUS_LOST).alias("lost_deal"),
                                    X.status_onehot("status", L.STATUS_WON).alias("won_deal"))


def d12(spark, sf):
    return _deals(spark, sf).select("id", X.days_since("won_time", AS_OF).alias("nights_from_won_date"))


def d13(spark, sf):
    deals = _deals(spark, sf).select("id", F.col("_te_needed_months_to_rent_").alias("raw"))
    return with_needed_months(deals, "raw", "rent_duration_categorical")


def d14(spark, sf):
    deals = with_needed_months(_deals(spark, sf), "_te_needed_months_to_rent_", "rent_duration_categorical")
    return deals.select("id", "rent_duration_categorical",
                        X.needed_months_nights("rent_duration_categorical").alias("nights_per_rent_duration"))


def d15(spark, sf):
    return sources(spark, sf).bookings.select(
        "booking_id", X.days_between("booked_to", "booked_from").alias("nights_per_rent_duration"))


def d16(spark, sf):
    return sources(spark, sf).bookings.select("booking_id", X.nights_spent_floored("booked_from", AS_OF).alias(
        "nights_spent"))


def d17(spark, sf):
    return enriched_bookings(sources(spark, sf), AS_OF, "landlord").select("booking_id", "price", "city", "beds",
                                                                           "is_online")


def d17b(spark, sf):
    return enriched_bookings(sources(spark, sf), AS_OF, "landlord", core_first=True).select(
        "booking_id", "price", "city", "beds", "is_online")


def d18(spark, sf):
    return sources(spark, sf).listings.select("listing_id", "price",
                                              X.price_class("price").alias("prd_rent_per_person_categorical"))


def d32(spark, sf):
    d = stage_deals(_deals(spark, sf), DealRules(), AS_OF, pipeline=L.LANDLORD_PIPELINE)
    occ, req = X.occupancy_flags("won_deal", "open_deal", "lost_deal")
    return d.select("id", "email", occ.alias("ls_is_occupied"), req.alias("ls_has_requests"))


# ----------------------------------------------------------------------------- D (in a mart) and M
def _mart(name: str):
    def q(spark, sf):
        return M.MARTS[name](sources(spark, sf), AS_OF)
    return q


def _mart_cols(name: str, cols: list[str]):
    def q(spark, sf):
        src = sources(spark, sf)
        mart = M.FEW_COLUMNS[name](src, AS_OF, cols) if name in M.FEW_COLUMNS else M.MARTS[name](src, AS_OF)
        return mart.select(*cols)
    return q


MART_RULES = {
    "d16b": ("m2", ["pd_id", "prd_bookingid", "nights_spent"]),
    "d19": ("m1", ["pd_id", "prd_bookingid", "max_rent_duration_categorical"]),
    "d19b": ("m8d", ["pd_id", "prd_bookingid", "max_rent_duration_categorical", "pd_te_rent_duration_raw"]),
    "d20": ("m1", ["source_flag", "pd_id", "prd_bookingid"]),
    "d20b": ("m2", ["source_flag", "pd_id", "prd_bookingid"]),
    "d20c": ("m3", ["data_source", "email", "in_product", "in_pipedrive", "both_sources", "source_flag"]),
    "d21": ("m1", ["pd_id", "prd_bookingid", "distinct_bk_id"]),
    "d21b": ("m2", ["pd_id", "prd_bookingid", "distinct_ids"]),
    "d22": ("m4", ["pd_ls_id", "prd_ls_id", "email", "city", "beds", "price"]),
    "d22b": ("m2", ["pd_id", "prd_bookingid", "city"]),
    "d23": ("m1", ["pd_id", "prd_bookingid", "max_nights_per_rent_duration", "min_nights_per_rent_duration",
                   "nights_per_rent_duration"]),
    "d24": ("m1", ["pd_id", "prd_bookingid", "prd_nights_rent_duration"]),
    "d25": ("m6", ["pd_id", "prd_listing_request_id", "rent_per_person_categorical", "number_of_tenants",
                   "children"]),
    "d25b": ("m8", ["pd_id", "prd_bookingid", "number_of_tenants"]),
    "d26": ("m1", ["pd_id", "prd_bookingid", "rent_per_person_categorical"]),
    "d27": ("m1", ["pd_id", "prd_bookingid", "rooms"]),
    "d28": ("m1", ["pd_id", "prd_bookingid", "accommodates", "is_bookable", "is_online", "is_canceled",
                   "is_deleted"]),
    "d29": ("m6", ["pd_id", "prd_listing_request_id", "tenant_id", "adults", "accommodates"]),
    "d30": ("m1", ["pd_id", "prd_bookingid", "prd_booked_from", "prd_booked_to"]),
    "d31": ("m2", ["pd_id", "prd_bookingid", "prd_accommodates", "is_bookable", "is_online"]),
    "d33": ("m7", ["data_surce", "email", "id", "number_of_tenants", "adults"]),
    "d34": ("m6", ["pd_id", "prd_listing_request_id", "deal_status"]),
    "d35": ("m6", ["pd_id", "prd_listing_request_id", "pd_status_reason", "prd_lost_reason"]),
}

_ROWWISE = ["s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8",
            "p1", "p2", "p3", "p4", "p5", "p6", "p7", "p8", "p9", "p10", "p11", "p12", "p13", "p14", "p15",
            "p16", "p17", "p18", "p19", "p20",
            "j1", "j2", "j3", "j4", "j5a", "j5b", "j5c", "j5d", "j5e", "j5f", "j5g", "j5h", "j5i", "j5j", "j5k",
            "j5r", "j6", "j7", "j8", "a1", "a2", "a3", "u1",
            "f1", "f2", "f3", "f4", "f5", "f6", "f7", "f8", "f9", "f10",
            "d1", "d2", "d2b", "d3", "d4", "d5", "d6", "d7", "d8", "d8b", "d9", "d9b", "d9c", "d9d", "d10",
            "d10b", "d10c", "d11", "d12", "d13", "d14", "d15", "d16", "d17", "d17b", "d18", "d32"]


def inventory_queries() -> dict[str, Query]:
    g = globals()
    out: dict[str, Query] = {name: g[name] for name in _ROWWISE}
    for name, (mart, cols) in MART_RULES.items():
        out[name] = _mart_cols(mart, cols)
    for name in M.MARTS:
        out[name] = _mart(name)
    return out
