from .aggregate import distinct_pairs, regroup_string_agg, string_agg
from .joins import left_join_split
from .lookup import with_lookup
from .reconcile import full_outer_reconcile, reconcile_parts, shared_keys, without_shared
from .union import union_positional
from .unnest import explode_keep_empty, explode_primary

__all__ = ["distinct_pairs", "regroup_string_agg", "string_agg", "left_join_split", "full_outer_reconcile", "reconcile_parts", "shared_keys", "with_lookup", "without_shared",
           "union_positional", "explode_keep_empty", "explode_primary"]
