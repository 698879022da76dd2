"""recomart: two-source reconciliation marts on Spark.

Typical use::

    from recomart import build_session, Sources, marts
    spark = build_session()
    src = Sources.from_tables(spark)            # or Sources.from_parquet / domain_sources
    df = marts.booking_mart(src, marts.M1, as_of="2024-01-01")
    publish(df, "landlord_bookings")
"""

from .plans import marts
from .session import apply_conventions, build_session
from .sources import Sources, domain_sources, publish

__all__ = ["marts", "apply_conventions", "build_session", "Sources", "domain_sources", "publish"]
