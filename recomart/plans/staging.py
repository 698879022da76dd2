"""Staged models: the sources and the booking models, written once and read by all marts.

``stage`` writes every source, finds out whether ``booking_id`` is a key (ids alone are read for that, and one row
reaches the driver), and writes a booking model per contact, and one for the first version of the
landlord mart, whose values come from the catalogues in the other order: the bookings with one
value per listing attribute, request pairs, stay lengths and the contact. The six booking marts then start
from their model's files; the chain of listing joins and what is derived from it run once and not once per mart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.catalog import Sources
from .product import picked_bookings

#: Contact, and whether the core catalogue's values come first.
MODELS = (("landlord", False), ("tenant", False), ("landlord", True))


def is_key(src: Sources) -> bool:
    """Whether every booking has an id that no other booking has."""
    ids = src.bookings.groupBy("booking_id").count()
    return ids.where(F.col("booking_id").isNull() | (F.col("count") > 1)).isEmpty()


def stage(src: Sources, path: str, partitions: int | None = None) -> Sources:
    """``src`` written under ``path`` (a shared folder), bound to the written files and models."""
    root = path.rstrip("/")
    staged = src.materialize(root, partitions)
    return stage_models(staged, root)


def stage_models(staged: Sources, path: str) -> Sources:
    """The booking models of already written sources, written under ``path``."""
    spark = staged.bookings.sparkSession
    key = is_key(staged)
    found = Sources(**staged.as_dict(), booking_id_is_key=key)
    models = {}
    for contact, core_first in MODELS:
        target = f"{path.rstrip('/')}/booking_model_{contact}{'_core_first' if core_first else ''}"
        picked_bookings(found, contact, core_first).write.mode("overwrite").parquet(target)
        models[contact, core_first] = spark.read.parquet(target)
    found.booking_models = models
    return found
