"""Explicit schemas of the domain inputs (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

EMAIL_ELEMENT = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("primary", T.BooleanType()),
])
EMAIL_ARRAY = T.ArrayType(EMAIL_ELEMENT)
PERSON = T.StructType([T.StructField("email", EMAIL_ARRAY)])

_S, _L, _B, _D, _TS, _DT = (T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(),
                            T.TimestampNTZType(), T.DateType())


def _struct(*cols):
    return T.StructType([T.StructField(n, t) for n, t in cols])


CRM_DEALS = _struct(
    ("id", _L), ("pipeline_id", _L), ("title", _S), ("person_name", _S), ("person_id", PERSON),
    ("ll_cities", _S), ("ll_cities_cleaned", T.ArrayType(_S)), ("te_cities_cleaned", T.ArrayType(_S)),
    ("deleted", _B), ("owner_name", _S), ("cc_email", _S), ("add_time", _TS), ("update_time", _TS),
    ("stage_change_time", _TS), ("status", _S), ("close_time", _TS), ("won_time", _TS),
    ("first_won_time", _TS), ("lost_time", _TS), ("lost_reason", _S),
    ("_ll_maximum_rent_duration_possible_", _S), ("_ll_rent_per_person_", _S), ("_ll_pets_possible_", _S),
    ("te_move_in_date", _DT), ("te_priority", _S), ("te_pets_cleaned", _S),
    ("te_disabled_help_needed_people_cleaned", _S), ("_ll_amount_rental_units_", _L),
    ("_ll_beds_available_in_total_", _L), ("ll_slots_available_edit_team_1", _L),
    ("te_number_of_people_in_the_group_keep_updated", _L), ("te_number_of_children_under_18_", _L),
    ("_te_needed_months_to_rent_", _S),
)
BOOKINGS = _struct(
    ("booking_id", _S), ("landlord_id", _S), ("tenant_id", _S), ("listing_id", _S),
    ("actual_booking_created_at", _TS), ("booked_from", _DT), ("booked_to", _DT), ("is_canceled", _B),
    ("number_of_tenants", _L),
)
LISTINGS = _struct(
    ("listing_id", _S), ("landlord_id", _S), ("city", _S), ("is_bookable", _B), ("is_online", _B),
    ("is_published", _B), ("is_deleted", _B), ("has_requests", _B), ("created_at", _TS),
    ("available_from", _TS), ("available_to", _TS), ("beds", _L), ("price", _D), ("rooms", _L),
    ("accommodates", _L), ("area", _D), ("next_available_date", _DT),
)
LISTING_REQUESTS = _struct(
    ("listing_request_id", _S), ("listing_id", _S), ("tenant_id", _S), ("created_at", _TS),
    ("requested_from", _DT), ("requested_to", _DT), ("listing_city", _S), ("listing_price", _D),
    ("deal_status", _S), ("status_reason", _S), ("adults", _L), ("children", _L),
    ("number_of_tenants", _L), ("tenant_has_pets", _B), ("pets_allowed", _S),
)
LANDLORDS = _struct(("landlord_id", _S), ("freshworks_email", _S))
USERS = _struct(("user_id", _S), ("email", _S))
TENANTS = _struct(("tenant_id", _S),)

SCHEMAS = {
    "deals": CRM_DEALS, "bookings": BOOKINGS, "listings": LISTINGS, "core_listings": LISTINGS,
    "listing_requests": LISTING_REQUESTS, "landlords": LANDLORDS, "users": USERS, "tenants": TENANTS,
}
