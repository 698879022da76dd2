"""M1-M8d: the reconciliation marts.

Each mart = CRM staging (``deals.py``) + product side (``product.py``) +
one reconciliation (full outer on e-mail, or left join UNION ALL anti join)
+ the merge rules of ``functions/expr.py``. The marts differ only in
configuration, so each is a few lines over three builders.

``as_of`` is the reporting date (None = today). The full join is the skew-safe one
of ``operators/reconcile.py``, the same plan at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X
from ..functions import labels as L
from ..operators.joins import left_join_split
from ..operators.reconcile import full_outer_reconcile, reconcile_parts, shared_keys, without_shared
from ..operators.union import union_positional
from ..sources.catalog import Sources
from .deals import DealRules, crm_emails, crm_filter, stage_deals, with_needed_months
from .product import (booked_contacts, booking_contact_keys, exploded_pets, listing_contact_keys, listings_with_landlords,
                      packed_bookings, repeated_rows, request_contact_keys, requests_with_people)


def _pfx(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def pd(c: str):
    return F.col("pd__" + c)


def prd(c: str):
    return F.col("prd__" + c)


# ----------------------------------------------------------------------------- bookings
PETS = "pets_allowed"  # the column of a booking mart that a pets answer decides


@dataclass(frozen=True)
class BookingMart:
    pipeline: int
    contact: str                 # product e-mail: "landlord" (landlords) or "tenant" (users)
    email_name: str = "email"    # output name of the merged e-mail
    rules: DealRules = DealRules()
    tenant_columns: bool = False  # pd/prd/merged number_of_tenants + is_published
    needed_months: bool = False   # free-text duration class drives the nights (D13/D14/D19b)
    dimension_landlord: bool = False  # landlord_id of the landlord table (NULL without a landlord), not the booking's


M1 = BookingMart(L.LANDLORD_PIPELINE, "landlord", dimension_landlord=True)
M8 = BookingMart(L.TENANT_PIPELINE, "tenant", "te_email", DealRules(has_pets_rule="like_c", disability_rule="like_b"),
                 tenant_columns=True)
M8B = BookingMart(L.TENANT_PIPELINE, "tenant", "te_email", DealRules(has_pets_rule="like_d", disability_rule="like_c"),
                  tenant_columns=True)
M8C = BookingMart(L.TENANT_PIPELINE, "landlord", "email", DealRules(has_pets_rule="like_c", disability_rule="like_b"),
                  tenant_columns=True, dimension_landlord=True)
M8D = BookingMart(L.TENANT_PIPELINE, "tenant", "te_email", DealRules(has_pets_rule="like_d", disability_rule="like_c"),
                  tenant_columns=True, needed_months=True)


def crm_bookings(src: Sources, spec: BookingMart, as_of=None) -> DataFrame:
    """Won deals of the pipeline in the booking vocabulary (pd side)."""
    deals = crm_filter(stage_deals(src.deals, spec.rules, as_of, pipeline=spec.pipeline),
                       spec.pipeline, L.STATUS_WON)
    nights = F.col("nights_per_rent_duration")
    cols = [F.col("id"), F.col("email"), F.col("won_time").alias("created_at"),
            F.col("min_nights_per_rent_duration"), F.col("max_nights_per_rent_duration"),
            F.col("ll_max_rent_duration"), F.col("nights_from_won_date").alias("nights_spent"),
            F.col("ll_rent_per_person_numeric").alias("price"), F.col("ll_rent_per_person"),
            F.col("_ll_beds_available_in_total_").alias("beds"),
            F.col("ll_slots_available_edit_team_1").alias("beds_edited_team1"),
            F.col("city"), F.col("ll_pets_allowed_bool").alias("pets_allowed")]
    if spec.tenant_columns:
        cols.append(F.col("te_number_of_people_in_the_group_keep_updated").alias("number_of_tenants"))
    if spec.needed_months:
        deals = with_needed_months(deals, "_te_needed_months_to_rent_", "rent_duration_categorical")
        cols += [F.col("rent_duration_categorical"),
                 X.needed_months_nights("rent_duration_categorical").alias("nights_per_rent_duration"),
                 F.col("_te_needed_months_to_rent_")]
    else:
        cols.append(nights)
    return deals.select(*cols)


def _reconciled_bookings(src: Sources, deals: DataFrame, as_of, contact: str, core_first: bool = False,
                         columns: Sequence[str] | None = None) -> DataFrame:
    """Deals (pd__) FULL OUTER bookings (prd__) on e-mail, the pets answers of a booking's listing still one array. Rows
    without an e-mail are dealt by ids that are at hand, so that a narrow query reads no other column for it.

    The e-mail is the contact's, so deals are reconciled with the contacts that have bookings, one short row each, and a
    booking takes all rows of its contact where it would take the contact: the bookings are not dealt by e-mail, and
    the listing's columns, joined last, not at all. For the whole mart, deals without such a contact are put to the
    bookings before that, so that its wide rows are not handed on through a union; for a few columns that is dearer.
    Staged or bucketed bookings, whose listings are joined without an exchange, are reconciled themselves.

    For a caller of a few ``columns`` contacts are joined after the listings, so that each booking is shuffled once for either,
    with the listing values that are taken; pets answers that nobody reads travel as their number (``_with_pets_rows``)."""
    # the dates travel as one array: rows without a partner show no booked_to (D30), and with a column less
    # their branch could not share the exchange of the matched one
    dates = F.array("booked_from", "booked_to")
    left = _pfx(deals, "pd__")
    if (contact, core_first) in src.booking_models or src.listing_buckets:
        right = packed_bookings(src, as_of, contact, core_first).withColumn("dates", dates)
        return full_outer_reconcile(left, _pfx(right.drop("booked_from", "booked_to"), "prd__"), "pd__email", "prd__email",
                                    right_keys=booking_contact_keys(src, contact, core_first), left_spread=["pd__id"],
                                    right_spread=["prd__booking_id", "prd__listing_id"])
    matched, deals_only, contacts_only = reconcile_parts(
        left, booked_contacts(src, contact, core_first), "pd__email", "contact", left_spread=["pd__id"],
        right_spread=["contact_id"])
    if columns is not None:
        # rows of a contact, looked up in a hash table
        people = matched.unionByName(contacts_only).hint("shuffle_hash")
        right = packed_bookings(src, as_of, contact, core_first, people, few=True,
                                answers=PETS in columns).withColumn("dates", dates)
        right = right.select(*[F.col(c).alias(c if c in left.columns else "prd__" + c) for c in right.columns])
        return right.unionByName(deals_only.select(*left.columns), allowMissingColumns=True)
    # a deal travels as one struct, NULL for the many bookings without one; its e-mail is the contact's where it has one
    fields = [c for c in left.columns if c != "pd__email"]
    deal, email = F.struct(*fields).alias("deal"), F.col("pd__email")
    matched = matched.select("contact_id", "contact", deal, F.lit(None).cast("string").alias("pd__email"))
    contacts_only = contacts_only.select("contact_id", "contact", *[
        F.lit(None).cast(matched.schema[c].dataType).alias(c) for c in ("deal", "pd__email")])
    people = matched.unionByName(contacts_only).hint("shuffle_hash")
    alone = deals_only.select(deal, email, F.xxhash64("pd__id").alias("spread"))
    j = packed_bookings(src, as_of, contact, core_first, people, alone).withColumn("dates", dates)
    own = [c for c in j.columns if c not in ("deal", "pd__email")]
    return j.select(*[F.col(c).alias("prd__" + c) for c in own], *[F.col(f"deal.{c}").alias(c) for c in fields],
                    F.when(F.col("deal").isNotNull(), F.coalesce(email, "email")).alias("pd__email"))


def _with_pets_rows(j: DataFrame, cols: list, rule) -> DataFrame:
    """``cols`` of ``j``, and among them the column ``PETS``, ``rule`` of the pets answer ``prd__pets_allowed_raw`` and what
    ``cols`` has in its place. The answers become rows after the other rules, which so are worked out once a booking.
    Where the answers' number is there in their place, their rows have no such column."""
    ruled = j.select(*cols, "prd__pets")
    names = ruled.columns[:-1]
    if not isinstance(ruled.schema["prd__pets"].dataType, T.ArrayType):
        return repeated_rows(ruled.drop(PETS), "prd__pets")
    return exploded_pets(ruled, "prd__pets", "prd__pets_allowed_raw").select(
        *[rule(F.col(c)).alias(c) if c == PETS else c for c in names])


def booking_mart(src: Sources, spec: BookingMart = M1, as_of=None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """M1 / M8 / M8b / M8c / M8d. ``columns``: the same rows, planned for a caller who takes these few columns."""
    # the months' class and text travel as one array, like the dates
    deals = crm_bookings(src, spec, as_of)
    if spec.needed_months:
        months = ("rent_duration_categorical", "_te_needed_months_to_rent_")
        deals = deals.withColumn("months", F.array(*months)).drop(*months)
    j = _reconciled_bookings(src, deals, as_of, spec.contact, columns=columns)
    booked_from, booked_to = prd("dates")[0], prd("dates")[1]

    prd_cls = X.price_class(prd("price"))
    if spec.needed_months:
        category = X.stay_class_gated(pd("months")[0], pd("ll_max_rent_duration"),
                                      prd("nights_per_rent_duration"))
    else:
        category = X.stay_class(pd("ll_max_rent_duration"), prd("nights_per_rent_duration"))
    cols = [
        X.source_flag(pd("id"), prd("booking_id")).alias("source_flag"),
        X.prefer(prd("booking_id"), pd("id")).alias("distinct_bk_id"),
        pd("id").alias("pd_id"), prd("booking_id").alias("prd_bookingid"),
        X.prefer(prd("email"), pd("email")).alias(spec.email_name),
        pd("email").alias("pd_email"), prd("email").alias("prd_email"),
        prd("contact_id" if spec.dimension_landlord else "landlord_id").alias("landlord_id"),
        X.prefer(F.to_date(prd("created_at")), pd("created_at")).alias("created_at"),
        pd("created_at").alias("pd_created_at"), prd("created_at").alias("prd_created_at"),
        booked_from.alias("prd_booked_from"),
        X.booked_to_quirk(pd("id"), prd("booking_id"), booked_from, booked_to).alias("prd_booked_to"),
        X.prefer(prd("city"), pd("city")).alias("city"),
        X.prefer(pd("max_nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "max_nights_per_rent_duration"),
        X.prefer(pd("min_nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "min_nights_per_rent_duration"),
        X.prefer(pd("nights_per_rent_duration"), prd("nights_per_rent_duration")).alias("nights_per_rent_duration"),
        X.only_when_null(pd("nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "prd_nights_rent_duration"),
        pd("ll_max_rent_duration").alias("pd_max_rent_duration_raw"),
        category.alias("max_rent_duration_categorical"),
    ]
    if spec.needed_months:
        cols.append(pd("months")[1].alias("pd_te_rent_duration_raw"))
    if spec.tenant_columns:
        cols += [pd("number_of_tenants").alias("pd_number_of_tenants"),
                 prd("prd_number_of_tenants").alias("prd_number_of_tenants"),
                 X.by_presence(prd("email"), prd("prd_number_of_tenants"), pd("email"), pd("number_of_tenants")).alias(
                     "number_of_tenants")]
    cols += [
        X.prefer(prd("nights_spent"), pd("nights_spent")).alias("nights_spent"),
        X.prefer(prd("beds"), pd("beds_edited_team1")).alias("pd_beds_edited_team1"),
        X.prefer(prd("beds"), pd("beds")).alias("beds"),
        X.prefer(prd("price"), pd("price").cast("double")).alias("price"),
        X.prefer(prd_cls, pd("ll_rent_per_person")).alias("rent_per_person_categorical"),
        pd("ll_rent_per_person").alias("pd_ll_rent_per_person"),
        prd_cls.alias("prd_rent_per_person_categorical"),
        X.when_present(prd("email"), prd("rooms")).alias("rooms"),
        prd("accommodates").alias("accommodates"),
        pd("pets_allowed").alias("pets_allowed"),
        prd("is_bookable").alias("is_bookable"), prd("is_online").alias("is_online"),
        prd("is_canceled").alias("is_canceled"), prd("is_deleted").alias("is_deleted"),
    ]
    if spec.tenant_columns:
        cols.append(prd("is_published").alias("is_published"))
    return _with_pets_rows(j, cols, lambda own: X.prefer(X.to_bool("prd__pets_allowed_raw"), own))


def booking_mart_v1(src: Sources, as_of=None, columns: Sequence[str] | None = None) -> DataFrame:
    """M2: first version -- core-first fallback, e-mail based flag and ids. ``columns``: see ``booking_mart``."""
    rules = DealRules(pets_as_int=True, has_pets_as_int=True)
    deals = crm_filter(stage_deals(src.deals, rules, as_of, pipeline=L.LANDLORD_PIPELINE),
                       L.LANDLORD_PIPELINE, L.STATUS_WON)
    deals = deals.select(
        "email", "id", "city", "won_time", "nights_from_won_date", "ll_max_rent_duration",
        F.col("_ll_beds_available_in_total_").alias("beds"),
        F.col("ll_slots_available_edit_team_1").alias("beds_edited_team1"),
        F.col("_ll_amount_rental_units_").alias("total_rental_units"),
        F.col("ll_rent_per_person").alias("price_cat"), F.col("ll_rent_per_person_numeric").alias("price"),
        "ll_pets_allowed", "nights_per_rent_duration", "min_nights_per_rent_duration",
        "max_nights_per_rent_duration")
    j = _reconciled_bookings(src, deals, as_of, "landlord", core_first=True, columns=columns)
    booked_from, booked_to = prd("dates")[0], prd("dates")[1]
    flag = X.source_flag(pd("email"), prd("email"))
    nights = X.days_between(booked_to, booked_from)
    city = (F.when(pd("city").isNotNull() & prd("city").isNotNull(), prd("city"))
            .when(pd("city").isNull() & prd("email").isNotNull(), prd("city"))
            .when(pd("email").isNotNull() & prd("email").isNull(), pd("city")))
    cols = [
        pd("id").alias("pd_id"), prd("booking_id").alias("prd_bookingid"),
        X.unified_id_gated(pd("id"), prd("booking_id"), prd("email")).alias("distinct_ids"),
        X.prefer(prd("email"), pd("email")).alias("email"),
        prd("landlord_id").alias("prd_landlord_id"),
        city.alias("city"),
        X.prefer(F.to_date(prd("listing_created_at")), pd("won_time")).alias("created_at"),
        booked_from.alias("prd_booked_from"), booked_to.alias("prd_booked_to"),
        X.prefer(pd("max_nights_per_rent_duration"), nights).alias("max_nights_per_rent_duration"),
        X.prefer(pd("min_nights_per_rent_duration"), nights).alias("min_nights_per_rent_duration"),
        X.prefer(pd("nights_per_rent_duration"), nights).alias("nights_per_rent_duration"),
        X.only_when_null(pd("nights_per_rent_duration"), nights).alias("prd_nights_rent_duration"),
        X.stay_class(pd("ll_max_rent_duration"), nights).alias("pd_max_rent_duration"),
        pd("ll_max_rent_duration").alias("pd_max_rent_duration_raw"),
        X.prefer(F.coalesce(prd("nights_spent"), X.days_since(booked_from, as_of)),
                 pd("nights_from_won_date")).alias("nights_spent"),
        X.prefer(prd("beds"), pd("beds_edited_team1")).alias("pd_beds_edited_team1"),
        X.prefer(prd("beds"), pd("beds")).alias("beds"),
        X.prefer(prd("price"), pd("price").cast("double")).alias("price"),
        pd("price_cat").alias("pd_price_range"),
        pd("ll_pets_allowed").alias("pets_allowed"),
        pd("total_rental_units").alias("pd_rental_units"),
        X.when_present(prd("email"), prd("rooms")).alias("prd_rooms"),
        X.flag_gated(flag, prd("accommodates")).alias("prd_accommodates"),
        X.flag_gated(flag, prd("is_bookable")).alias("is_bookable"),
        X.flag_gated(flag, prd("is_online")).alias("is_online"),
        flag.alias("source_flag"),
    ]
    return _with_pets_rows(j, cols, lambda own: X.prefer(prd("pets_allowed_raw"), own))


# ----------------------------------------------------------------------------- listings
def listing_mart(src: Sources, as_of=None, extended: bool = False) -> DataFrame:
    """M4 (``extended=False``) and M5 (``extended=True``): landlord listings, full join."""
    if extended:
        rules = DealRules(city="explode", unsure_as_null=True, has_pets_rule="like_c", disability_rule="like_b")
    else:
        rules = DealRules(city="scalar_fanout", unsure_as_null=True, has_pets_as_int=True)
    deals = crm_filter(stage_deals(src.deals, rules, as_of, pipeline=L.LANDLORD_PIPELINE), L.LANDLORD_PIPELINE)
    occupied, requests = X.occupancy_flags("won_deal", "open_deal", "lost_deal")
    left = _pfx(deals.select(
        "id", "email", F.col("add_time").alias("created_at"), F.col("_ll_beds_available_in_total_").alias("beds"),
        F.col("ll_slots_available_edit_team_1").alias("beds_edited_team1"),
        F.col("ll_rent_per_person").alias("rent_per_person_categorical"),
        F.col("ll_rent_per_person_numeric").alias("price"), "city", "ll_max_rent_duration",
        "nights_per_rent_duration", "min_nights_per_rent_duration", "max_nights_per_rent_duration",
        "nights_from_won_date", F.col("nights_from_won_date").alias("nights_spent"),
        F.col("ll_pets_allowed_bool").alias("pets_allowed"), "open_deal", "lost_deal", "won_deal",
        occupied.alias("ls_is_occupied"), requests.alias("ls_has_requests")), "pd__")
    right = _pfx(listings_with_landlords(src), "prd__")
    j = full_outer_reconcile(left, right, "pd__email", "prd__freshworks_email",
                             right_keys=listing_contact_keys(src))
    cols = [
        X.source_flag(pd("id"), prd("listing_id")).alias("source_flag"),
        X.prefer(prd("listing_id"), pd("id")).alias("distinct_ls_id"),
        pd("id").alias("pd_ls_id"), prd("listing_id").alias("prd_ls_id"),
        X.prefer(prd("freshworks_email"), pd("email")).alias("email"),
        pd("email").alias("pd_email"), prd("freshworks_email").alias("prd_email"),
        X.prefer(F.to_date(prd("created_at")), pd("created_at")).alias("created_at"),
        pd("created_at").alias("pd_created_at"), prd("created_at").alias("prd_created_at"),
        X.prefer(prd("city"), pd("city")).alias("city"),
        pd("city").alias("pd_city"), prd("prd_city").alias("prd_city"),
        pd("nights_per_rent_duration").alias("pd_nights_per_rent_duration"),
        pd("min_nights_per_rent_duration").alias("pd_min_nights_per_rent_duration"),
        pd("max_nights_per_rent_duration").alias("pd_max_nights_per_rent_duration"),
        pd("ll_max_rent_duration").alias("pd_ll_max_rent_duration"),
        pd("nights_spent").alias("pd_nights_spent"),
        X.prefer(prd("beds"), pd("beds_edited_team1")).alias("pd_beds_edited_team1"),
        X.prefer(prd("beds"), pd("beds")).alias("beds"),
        pd("price").alias("pd_price"), prd("price").alias("prd_price"),
        X.prefer(prd("price"), pd("price").cast("double")).alias("price"),
        pd("rent_per_person_categorical").alias("pd_rent_per_person_categorical"),
        prd("prd_rent_per_person_categorical").alias("prd_rent_per_person_categorical"),
        X.prefer(prd("prd_rent_per_person_categorical"), pd("rent_per_person_categorical")).alias(
            "rent_per_person_categorical"),
        prd("accommodates").alias("accommodates"), prd("is_bookable").alias("is_bookable"),
        prd("is_online").alias("is_online"), prd("is_deleted").alias("is_deleted"),
    ]
    if extended:
        cols += [prd("is_published").alias("is_published"), pd("open_deal").alias("pd_open_deal"),
                 pd("lost_deal").alias("pd_lost_deal"), pd("won_deal").alias("pd_won_deal")]
    return j.select(*cols)


def listing_union_mart(src: Sources, as_of=None) -> DataFrame:
    """M3: CRM rows left-joined to product rows, UNION ALL product rows without a CRM partner."""
    rules = DealRules(city="explode", id_as_string=False, dates_as_date=False, pets_as_int=True,
                      has_pets_as_int=True)
    crm = crm_filter(stage_deals(src.deals, rules, as_of, pipeline=L.LANDLORD_PIPELINE), L.LANDLORD_PIPELINE)
    ll = src.landlords.select(F.col("landlord_id").alias("ll_landlord_id"), "freshworks_email")
    prod = src.listings.join(ll, F.col("landlord_id") == F.col("ll_landlord_id"), "left")

    fw = prod.select(F.col("freshworks_email").alias("m_fw"))
    shared = shared_keys(crm_emails(src.deals, L.LANDLORD_PIPELINE), fw)
    crm_side = left_join_split(crm, fw, "email", "m_fw", shared)
    null_b, null_s, null_l = F.lit(None).cast("boolean"), F.lit(None).cast("string"), F.lit(None).cast("long")
    branch1 = crm_side.select(
        F.lit("Pipedrive").alias("data_source"), F.col("email"),
        X.true_or_null(F.col("email").isNull() & F.col("m_fw").isNotNull()).alias("in_product"),
        X.true_or_null(F.col("m_fw").isNull() & F.col("email").isNotNull()).alias("in_pipedrive"),
        X.true_or_null(F.col("m_fw").isNotNull() & F.col("email").isNotNull()).alias("both_sources"),
        F.col("city"), null_s.alias("prd_listing_id"), null_b.alias("prd_is_bookable"),
        null_b.alias("prd_is_online"), null_b.alias("prd_is_published"), null_b.alias("prd_is_deleted"),
        F.col("_ll_beds_available_in_total_").alias("total_beds"),
        F.col("ll_slots_available_edit_team_1").alias("pd_total_beds_edit_team1"),
        F.col("ll_pets_allowed_bool").alias("pd_pets_allowed"),
        F.col("ll_max_rent_duration").alias("pd_max_rent_duration"),
        F.col("ll_rent_per_person").alias("pd_rent_per_person"),
        F.col("nights_from_won_date").alias("pd_nights_from_won_date"),
        F.col("open_deal").alias("pd_open_deal"), F.col("won_deal").alias("pd_won_deal"),
        F.col("lost_deal").alias("pd_lost_deal"))
    # Product rows whose e-mail has no CRM partner (NULL e-mails included): J7 anti join.
    lonely = without_shared(prod, "freshworks_email", shared)
    branch2 = lonely.select(
        F.lit("Product"), F.col("freshworks_email"),
        X.true_or_null(F.col("freshworks_email").isNotNull()), null_b, null_b,
        F.lower("city"), F.col("listing_id"), F.col("is_bookable"), F.col("is_online"),
        F.col("is_published"), F.col("is_deleted"), F.col("beds"), null_l, null_l, null_s,
        X.number_text(F.col("price")), null_l, null_l, null_l, null_l)
    u = union_positional(branch1, branch2)
    return u.withColumn("source_flag", X.flag_from_truth("in_product", "in_pipedrive", "both_sources"))


# ----------------------------------------------------------------------------- tenants
def request_mart(src: Sources, as_of=None) -> DataFrame:
    """M6: tenant listing requests; CRM deals re-aggregated per person, full join on e-mail."""
    rules = DealRules(city="aggregate")
    deals = crm_filter(stage_deals(src.deals, rules, as_of, pipeline=L.TENANT_PIPELINE))
    left = _pfx(deals.withColumnRenamed("city", "listing_city"), "pd__")
    r = requests_with_people(src, as_of, with_listing=True)
    right = _pfx(r.select(
        "listing_request_id", "listing_id", "tenant_id", "te_email",
        F.to_date("created_at").alias("lr_created_at"), "requested_from", "requested_to",
        X.days_between("requested_to", "requested_from").alias("nights_per_rent_duration"),
        F.col("listing_city").alias("city"), F.col("ls_is_bookable").alias("is_bookable"),
        F.col("ls_is_online").alias("is_online"), F.col("ls_is_deleted").alias("is_deleted"),
        X.nights_spent_floored("requested_from", as_of).alias("nights_spent"),
        F.col("ls_beds").alias("beds"), "listing_price", F.col("ls_rooms").alias("rooms"),
        F.col("ls_accommodates").alias("accommodates"), "deal_status", "status_reason", "adults", "children",
        "number_of_tenants", "tenant_has_pets", "pets_allowed"), "prd__")
    # Key source: the CRM rows before the re-aggregation (every group keeps its e-mail).
    j = full_outer_reconcile(left, right, "pd__email", "prd__te_email",
                             left_keys=crm_emails(src.deals, L.TENANT_PIPELINE),
                             right_keys=request_contact_keys(src))
    prd_cls = X.price_class(prd("listing_price"))
    prd_pets = X.to_bool(prd("pets_allowed"))
    prd_te_pets = prd("tenant_has_pets").cast("boolean")
    lr_id, pd_id = prd("listing_request_id"), pd("id")
    return j.select(
        X.source_flag(pd_id, lr_id).alias("source_flag"),
        pd_id.alias("pd_id"), lr_id.alias("prd_listing_request_id"),
        X.prefer(lr_id, pd_id).alias("listing_requests_ids_unified"),
        pd("email").alias("pd_email"), prd("te_email").alias("prd_email"),
        X.prefer(prd("te_email"), pd("email")).alias("email"),
        prd("tenant_id").alias("prd_tenant_id"), prd("tenant_id").alias("tenant_id"),
        pd("won_time").alias("pd_created_at"), prd("lr_created_at").alias("prd_created_at"),
        X.prefer(prd("lr_created_at"), pd("won_time")).alias("created_at"),
        prd("city").alias("prd_city"), pd("listing_city").alias("pd_preferred_cities"),
        X.prefer(prd("city"), pd("listing_city")).alias("city"),
        prd("requested_from").alias("requested_from"), prd("requested_to").alias("requested_to"),
        X.prefer(pd("max_nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "max_nights_per_rent_duration"),
        X.prefer(pd("min_nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "min_nights_per_rent_duration"),
        X.prefer(pd("nights_per_rent_duration"), prd("nights_per_rent_duration")).alias("nights_per_rent_duration"),
        X.only_when_null(pd("nights_per_rent_duration"), prd("nights_per_rent_duration")).alias(
            "prd_nights_rent_duration"),
        pd("ll_max_rent_duration").alias("pd_max_rent_duration"),
        prd("nights_per_rent_duration").alias("prd_nights_per_rent_duration"),
        X.stay_class(pd("ll_max_rent_duration"), prd("nights_per_rent_duration")).alias(
            "max_rent_duration_categorical"),
        pd("status").alias("pd_status"), prd("deal_status").alias("prd_status"),
        X.merged_lower(prd("deal_status"), pd("status")).alias("deal_status"),
        prd("status_reason").alias("pd_status_reason"), F.lower(pd("lost_reason")).alias("prd_lost_reason"),
        X.prefer(prd("status_reason"), pd("lost_reason")).alias("status_reason"),
        pd("nights_from_won_date").alias("pd_nights_spent"), prd("nights_spent").alias("prd_nights_spent"),
        X.prefer(prd("nights_spent"), pd("nights_from_won_date")).alias("nights_spent"),
        X.prefer(prd("beds"), pd("ll_slots_available_edit_team_1")).alias("pd_beds_edited_team1"),
        X.prefer(prd("beds"), pd("_ll_beds_available_in_total_")).alias("beds"),
        pd("ll_rent_per_person_numeric").alias("pd_ll_rent_per_person_numeric"),
        prd("listing_price").alias("prd_listing_price"),
        X.prefer(prd("listing_price"), pd("ll_rent_per_person_numeric").cast("double")).alias("price"),
        pd("ll_rent_per_person").alias("pd_ll_rent_per_person"),
        prd_cls.alias("prd_rent_per_person_categorical"),
        X.by_presence(lr_id, prd_cls, pd_id, pd("ll_rent_per_person")).alias("rent_per_person_categorical"),
        X.when_present(prd("te_email"), prd("rooms")).alias("rooms"),
        prd("accommodates").alias("prd_accommodates"), prd("accommodates").alias("accommodates"),
        X.prefer(prd_pets, pd("ll_pets_allowed_bool")).alias("pets_allowed"),
        pd("te_priority").alias("deal_priority"),
        pd("te_has_pets").alias("pd_te_has_pets"), prd_te_pets.alias("prd_te_has_pets"),
        X.prefer(prd_te_pets, pd("te_has_pets")).alias("te_has_pets"),
        pd("te_number_of_people_in_the_group_keep_updated").alias("pd_number_of_tenants"),
        prd("number_of_tenants").alias("prd_number_of_tenants"),
        X.by_presence(lr_id, prd("number_of_tenants"), pd_id,
                      pd("te_number_of_people_in_the_group_keep_updated")).alias("number_of_tenants"),
        prd("adults").alias("prd_adults"), prd("adults").alias("adults"),
        pd("te_number_of_children_under_18_").alias("pd_children"), prd("children").alias("prd_children"),
        X.by_presence(lr_id, prd("children"), pd_id, pd("te_number_of_children_under_18_")).alias("children"),
        pd("te_has_disability").alias("pd_te_has_disability"), pd("te_has_disability").alias("te_has_disability"),
        pd("open_deal").alias("pd_open_deal"), pd("lost_deal").alias("pd_lost_deal"),
        pd("won_deal").alias("pd_won_deal"),
        prd("is_bookable").alias("is_bookable"), prd("is_online").alias("is_online"),
        prd("is_deleted").alias("is_deleted"),
    )


def tenant_union_mart(src: Sources, as_of=None, with_reason: bool = True) -> DataFrame:
    """M7 (``with_reason``) / M7b: tenants, CRM rows left-joined to requests UNION ALL lonely requests."""
    rules = DealRules(city="aggregate", id_as_string=False, dates_as_date=False, pets_as_int=True,
                      has_pets_rule="like_d", disability_rule="like_c", with_rent_number=False)
    crm = crm_filter(stage_deals(src.deals, rules, as_of, pipeline=L.TENANT_PIPELINE), L.TENANT_PIPELINE)
    r = requests_with_people(src, as_of, with_listing=False)
    prod = r.select(
        F.col("te_email").alias("p_email"), F.col("t_tenant_id").alias("p_tenant_id"),
        F.col("created_at").alias("p_created_at"),
        X.days_between("requested_to", "requested_from").alias("p_rent_duration"),
        F.col("listing_id").alias("p_listing_id"), F.col("listing_city").alias("p_city"),
        F.col("listing_price").alias("p_price"), F.col("deal_status").alias("p_status"),
        F.col("adults").alias("p_adults"), F.col("children").alias("p_children"),
        F.col("number_of_tenants").alias("p_n"), F.col("tenant_has_pets").alias("p_pets"),
        F.col("status_reason").alias("p_reason"))
    null_s, null_l = F.lit(None).cast("string"), F.lit(None).cast("long")
    shared = shared_keys(crm_emails(src.deals, L.TENANT_PIPELINE), request_contact_keys(src))
    m = left_join_split(crm, prod.select("p_email", "p_created_at"), "email", "p_email", shared)
    b1 = [F.lit("Pipedrive").alias("data_surce"), F.col("email"),
          X.true_or_null(F.col("email").isNull() & F.col("p_email").isNotNull()).alias("in_product"),
          X.true_or_null(F.col("email").isNotNull() & F.col("p_email").isNull()).alias("in_pipedrive"),
          X.true_or_null(F.col("email").isNotNull() & F.col("p_email").isNotNull()).alias("both_sources"),
          null_s.alias("tenant_id"), null_s.alias("listing_id"), F.col("p_created_at").alias("created_at"),
          null_l.alias("rent_duration"), F.col("id"), F.col("city"), F.col("ll_rent_per_person").alias("price"),
          F.col("status").alias("deal_status"),
          F.col("te_number_of_people_in_the_group_keep_updated").alias("number_of_tenants"),
          X.adults("te_number_of_people_in_the_group_keep_updated", "te_number_of_children_under_18_").alias(
              "adults"),
          F.col("te_number_of_children_under_18_").alias("number_of_children"), F.col("te_has_pets"),
          F.col("te_has_disability")]
    lonely = without_shared(prod, "p_email", shared)
    b2 = [F.lit("Product"), F.col("p_email"), X.true_or_null(F.col("p_email").isNotNull()),
          F.lit(None).cast("boolean"), F.lit(None).cast("boolean"), F.col("p_tenant_id"), F.col("p_listing_id"),
          F.col("p_created_at"), F.col("p_rent_duration"), null_l, F.col("p_city"), X.number_text(F.col("p_price")),
          F.col("p_status"), F.col("p_n"), F.col("p_adults"), F.col("p_children"), F.col("p_pets"), null_l]
    if with_reason:
        b1.append(F.col("lost_reason"))
        b2.append(F.col("p_reason"))
    u = union_positional(m.select(*b1), lonely.select(*b2))
    return u.withColumn("source_flag", X.flag_from_truth("in_product", "in_pipedrive", "both_sources"))


MARTS = {
    "m1": lambda s, a: booking_mart(s, M1, a),
    "m2": lambda s, a: booking_mart_v1(s, a),
    "m3": lambda s, a: listing_union_mart(s, a),
    "m4": lambda s, a: listing_mart(s, a, False),
    "m5": lambda s, a: listing_mart(s, a, True),
    "m6": lambda s, a: request_mart(s, a),
    "m7": lambda s, a: tenant_union_mart(s, a, True),
    "m7b": lambda s, a: tenant_union_mart(s, a, False),
    "m8": lambda s, a: booking_mart(s, M8, a),
    "m8b": lambda s, a: booking_mart(s, M8B, a),
    "m8c": lambda s, a: booking_mart(s, M8C, a),
    "m8d": lambda s, a: booking_mart(s, M8D, a),
}

#: The booking marts as planned for rules that take a few of their columns (all are there if the pets answer is).
FEW_COLUMNS = {
    "m1": lambda s, a, cols=(PETS,): booking_mart(s, M1, a, cols),
    "m2": lambda s, a, cols=(PETS,): booking_mart_v1(s, a, cols),
    "m8": lambda s, a, cols=(PETS,): booking_mart(s, M8, a, cols),
    "m8d": lambda s, a, cols=(PETS,): booking_mart(s, M8D, a, cols),
}
