"""Logical source binding.

A mart is written against logical names (``deals``, ``bookings`` ...). The
caller binds them to DataFrames: derived from the driver tables, read from
parquet with the explicit schema, or taken from catalog tables. One query text
therefore runs against any of them, which is what the warehouse templating did.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SCHEMAS

#: Sources whose ``listing_id`` is joined by the booking models.
LISTING_SOURCES = ("bookings", "listings", "core_listings", "listing_requests")


@dataclass
class Sources:
    """The eight logical sources, and what staging (``plans/staging.py``) has derived from them: whether
    ``booking_id`` was found to be a key, the written booking models by (contact, core_first), and the number of
    buckets by ``listing_id`` if the listing sources are bucketed; and, if whoever made the bookings knows it, the bookings
    in two parts: those whose id no other booking has, and the others. Binding a source anew forgets all of it."""

    deals: DataFrame
    bookings: DataFrame
    listings: DataFrame
    core_listings: DataFrame
    listing_requests: DataFrame
    landlords: DataFrame
    users: DataFrame
    tenants: DataFrame
    booking_id_is_key: bool = field(default=False, metadata={"derived": True})
    booking_models: dict[tuple[str, bool], DataFrame] = field(default_factory=dict, metadata={"derived": True})
    listing_buckets: int = field(default=0, metadata={"derived": True})
    booking_parts: tuple[DataFrame, DataFrame] | None = field(default=None, metadata={"derived": True})

    def __setattr__(self, name, value):
        if name in self.__dict__ and name in self.names():
            super().__setattr__("booking_id_is_key", False)
            super().__setattr__("booking_models", {})
            super().__setattr__("listing_buckets", 0)
            super().__setattr__("booking_parts", None)
        super().__setattr__(name, value)

    @classmethod
    def names(cls) -> list[str]:
        """Names of the logical sources."""
        return [f.name for f in fields(cls) if not f.metadata.get("derived")]

    @classmethod
    def from_tables(cls, spark: SparkSession, names: dict[str, str] | None = None) -> "Sources":
        """Bind to catalog tables / views; ``names`` maps logical -> physical name."""
        names = names or {}
        return cls(**{n: spark.table(names.get(n, n)) for n in cls.names()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: dict[str, str]) -> "Sources":
        """Read each logical source from parquet with its declared schema."""
        return cls(**{n: spark.read.schema(SCHEMAS[n]).parquet(paths[n]) for n in cls.names()})

    def materialize(self, path: str, partitions: int | None = None) -> "Sources":
        """Write every source once as parquet under ``path`` (a shared folder, e.g.
        below ``spark.checkpoint.dir``) and bind to the written files.

        This is the staging-model step: later marts read files (parallel scans,
        no recomputation of the derivation, lineage cut so a lost executor
        re-reads files instead of re-deriving)."""
        spark = self.deals.sparkSession
        out = {}
        for name in self.names():
            df = getattr(self, name)
            if partitions:
                df = df.repartition(partitions)
            target = f"{path.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(target)
            out[name] = spark.read.parquet(target)
        return Sources(**out)

    def bucket_by_listing(self, path: str, prefix: str, buckets: int) -> "Sources":
        """Write the sources that are joined by ``listing_id`` as tables ``<prefix><name>`` bucketed and sorted by it,
        under ``path``, and bind to them; the others stay bound as they are.

        Their joins then need no exchange, whatever their sizes. For catalogues and bookings without a hot
        listing only: the rows of a listing are one bucket, and AQE splits exchanges, not buckets. So this is a
        choice of the caller; the marts' plans split hot listings otherwise."""
        spark = self.bookings.sparkSession
        out = self.as_dict()
        for name in LISTING_SOURCES:
            table = prefix + name
            # each bucket is written by one task: one file per bucket
            (out[name].repartition(buckets, "listing_id").write.bucketBy(buckets, "listing_id").sortBy("listing_id")
             .option("path", f"{path.rstrip('/')}/{table}").saveAsTable(table))
            out[name] = spark.table(table)
        return Sources(**out, booking_id_is_key=self.booking_id_is_key, listing_buckets=buckets)

    def register(self, prefix: str = "") -> list[str]:
        """Expose every source as a temp view (for SQL users); returns the names of the views."""
        views = [prefix + n for n in self.names()]
        for name, view in zip(self.names(), views):
            getattr(self, name).createOrReplaceTempView(view)
        return views

    def require_keys(self, keys: dict[str, str] | None = None) -> None:
        """Raise if a key column repeats a value; one grouped count per source, of which only the first
        offender reaches the driver."""
        for name, key in (keys or {"bookings": "booking_id"}).items():
            twice = (getattr(self, name).where(F.col(key).isNotNull()).groupBy(key).count()
                     .where("count > 1").limit(1).collect())
            if twice:
                raise ValueError(f"{name}.{key} is not unique: {twice[0][key]!r} occurs {twice[0]['count']} times")

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.names()}
