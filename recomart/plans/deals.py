"""CRM deal staging (the ``deals`` step of every mart).

One builder covers all variants: which city form, which has-pets / disability
rule, whether "unsure" rent becomes NULL, whether pets are a boolean or 0/1,
and whether the cities are re-aggregated (A1/A2). Everything before the
optional re-aggregation is narrow: scan -> explode primary e-mails -> project.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import labels as L
from ..operators.aggregate import regroup_string_agg
from ..operators.lookup import with_lookup
from ..operators.unnest import explode_keep_empty, explode_primary


AGG_NOT_SELECTED = ("_ll_amount_rental_units_", "_te_needed_months_to_rent_")


@dataclass(frozen=True)
class DealRules:
    # "scalar": city = ll_cities; "explode": city = element of ll_cities_cleaned (J2 fan-out);
    # "scalar_fanout": city = ll_cities but rows still fan out on ll_cities_cleaned;
    # "aggregate": city = STRING_AGG over te_cities_cleaned, grouped by every other column.
    city: str = "scalar"
    id_as_string: bool = True
    dates_as_date: bool = True
    unsure_as_null: bool = False
    pets_as_int: bool = False
    has_pets_rule: str = "literal"
    has_pets_as_int: bool = False
    disability_rule: str = "literal"
    with_rent_number: bool = True


def _derived(rules: DealRules, as_of) -> list[Column]:
    """Row-wise projection of one (deal, primary e-mail) row, source column order."""
    add_time = F.to_date("add_time") if rules.dates_as_date else F.col("add_time")
    won_time = F.to_date("won_time") if rules.dates_as_date else F.col("won_time")
    dur = "_ll_maximum_rent_duration_possible_"
    rent = "_ll_rent_per_person_"
    cols = [
        F.col("pipeline_id"),
        (F.col("id").cast("string") if rules.id_as_string else F.col("id")).alias("id"),
        F.col("title"), F.col("person_name"), F.col("email"),
        F.col("owner_name"), F.col("cc_email"),
        add_time.alias("add_time"),
        F.col("update_time"), F.col("stage_change_time"), F.col("status"), F.col("close_time"),
        won_time.alias("won_time"),
        F.col("first_won_time"), F.col("lost_time"),
        F.coalesce(F.col("lost_reason"), F.lit(L.UNDEFINED)).alias("lost_reason"),
        X.days_since("won_time", as_of).alias("nights_from_won_date"),
        X.rent_duration_class(dur).alias("ll_max_rent_duration"),
        X.rent_per_person_class(rent, rules.unsure_as_null).alias("ll_rent_per_person"),
    ]
    if rules.with_rent_number:
        cols.append(X.rent_per_person_number(rent).alias("ll_rent_per_person_numeric"))
    cols += [
        X.pets_answer("_ll_pets_possible_").alias("ll_pets_allowed"),
        F.col("te_move_in_date"), F.col("te_priority"),
        X.rent_duration_typical_nights(dur).alias("nights_per_rent_duration"),
        X.rent_duration_min_nights(dur).alias("min_nights_per_rent_duration"),
        X.rent_duration_max_nights(dur).alias("max_nights_per_rent_duration"),
        (X.pets_flag("_ll_pets_possible_") if rules.pets_as_int else X.pets_bool("_ll_pets_possible_")).alias(
            "ll_pets_allowed_bool"),
        X.has_pets("te_pets_cleaned", rules.has_pets_rule, rules.has_pets_as_int).alias("te_has_pets"),
        X.has_disability("te_disabled_help_needed_people_cleaned", rules.disability_rule).alias(
            "te_has_disability"),
        X.status_onehot("status", L.STATUS_OPEN).alias("open_deal"),
        X.status_onehot("status", L.STATUS_LOST).alias("lost_deal"),
        X.status_onehot("status", L.STATUS_WON).alias("won_deal"),
        F.col("_ll_amount_rental_units_"),
        F.col("_ll_beds_available_in_total_"), F.col("ll_slots_available_edit_team_1"),
        F.col(rent), F.col(dur),
        F.col("te_number_of_people_in_the_group_keep_updated"), F.col("te_number_of_children_under_18_"),
        F.col("_te_needed_months_to_rent_"),
    ]
    return cols


def stage_deals(deals: DataFrame, rules: DealRules, as_of=None, pipeline: int | None = None) -> DataFrame:
    """Deals with one row per primary e-mail (J1) and the D1-D12 columns.

    ``pipeline`` filters before any re-aggregation (the filter is on a grouping
    column, so the place does not change the result; early is cheaper).
    """
    src = deals if pipeline is None else deals.where(F.col("pipeline_id") == pipeline)
    rows = explode_primary(src, "person_id.email", out="email")
    derived = _derived(rules, as_of)

    if rules.city == "scalar":
        return rows.select(*derived, F.col("ll_cities").alias("city"))
    if rules.city == "explode":
        fan = explode_keep_empty(rows, "ll_cities_cleaned", "__city")
        return fan.select(*derived, F.col("__city").alias("city"))
    if rules.city == "scalar_fanout":
        fan = explode_keep_empty(rows, "ll_cities_cleaned", "__city")
        return fan.select(*derived, F.col("ll_cities").alias("city"))
    if rules.city == "aggregate":
        # Group keys are exactly the source's: every projected column except the
        # two raw columns it does not select in this form.
        staged = rows.select(*derived, F.col("te_cities_cleaned")).drop(*AGG_NOT_SELECTED)
        keys = [c for c in staged.columns if c != "te_cities_cleaned"]
        return regroup_string_agg(staged, keys, "te_cities_cleaned", "city")
    raise ValueError(rules.city)


def crm_filter(df: DataFrame, pipeline: int | None = None, status: str | None = None) -> DataFrame:
    """Pipeline / status equality and the excluded lost reasons."""
    out = df.where(~F.col("lost_reason").isin(*L.EXCLUDED_LOST_REASONS))
    if pipeline is not None:
        out = out.where(F.col("pipeline_id") == pipeline)
    if status is not None:
        out = out.where(F.col("status") == status)
    return out


def crm_emails(deals: DataFrame, pipeline: int | None = None) -> DataFrame:
    """Primary e-mails of the deals that pass ``crm_filter`` (one column ``email``):
    the key set of any staging of these deals, without the derived columns."""
    src = deals if pipeline is None else deals.where(F.col("pipeline_id") == pipeline)
    reason = F.coalesce(F.col("lost_reason"), F.lit(L.UNDEFINED))
    return explode_primary(src.where(~reason.isin(*L.EXCLUDED_LOST_REASONS)), "person_id.email",
                           out="email").select("email")


def with_needed_months(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the class of a free-text duration answer; the 78 exact answers are a broadcast
    dictionary, rows without one fall to the LIKE rules."""
    return with_lookup(df, col, L.NEEDED_MONTHS_EQUALS, out, lambda found: X.needed_months_otherwise(found, col))
