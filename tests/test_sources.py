"""Public entry points: source bindings, the key check, the sink and the reporting date."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from recomart import publish
from recomart.functions import expr as X
from recomart.plans import marts as M
from recomart.plans.inventory import AS_OF, s7
from recomart.session import ensure_checkpoint_dir
from recomart.sources.adapter import domain_sources, read_driver
from recomart.sources.catalog import Sources

SF = "/root/testdata/sf0.001"
NAMES = ("deals", "bookings", "listings", "core_listings", "listing_requests", "landlords", "users", "tenants")


@pytest.fixture(scope="module")
def staged(spark):
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sources-{uuid.uuid4().hex}"
    domain_sources(spark, SF).materialize(folder)
    return folder


def test_from_parquet_scans_nested_deals(spark, staged):
    src = Sources.from_parquet(spark, {n: f"{staged}/{n}" for n in NAMES})
    want = M.listing_mart(domain_sources(spark, SF), AS_OF)
    got = M.listing_mart(src, AS_OF)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # only the nested field that is read is scanned
    plan = src.deals.select("id", F.col("person_id.email"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,person_id:struct<email:" in plan and "title" not in plan


def test_from_tables_binds_names(spark, staged):
    prefix = f"t{uuid.uuid4().hex}_"
    views = Sources.from_parquet(spark, {n: f"{staged}/{n}" for n in NAMES}).register(prefix)
    try:
        src = Sources.from_tables(spark, {n: prefix + n for n in NAMES})
        assert src.bookings.count() == read_driver(spark, SF, "lineitem").count()
    finally:
        for v in views:
            spark.catalog.dropTempView(v)


def test_every_driver_row_is_used(spark):
    src = domain_sources(spark, SF)
    n = {t: read_driver(spark, SF, t).count() for t in ("orders", "part", "customer", "supplier", "lineitem")}
    assert src.deals.count() == src.listing_requests.count() == n["orders"]
    assert src.listings.count() == src.core_listings.count() == n["part"]
    assert src.users.count() == src.tenants.count() == n["customer"]
    assert (src.landlords.count(), src.bookings.count()) == (n["supplier"], n["lineitem"])


def test_key_check(spark):
    src = domain_sources(spark, SF)
    src.require_keys()
    src.bookings = src.bookings.unionByName(src.bookings.limit(1))
    with pytest.raises(ValueError, match="bookings.booking_id is not unique"):
        src.require_keys()


def test_publish_table_view_and_parquet(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    name = f"pub_{uuid.uuid4().hex}"
    assert publish(df, name).count() == 2 and spark.table(name).count() == 2
    assert publish(df.limit(1), name).count() == 1  # overwrites
    spark.sql(f"DROP TABLE {name}")
    publish(df, name, mode="view")
    assert spark.table(name).count() == 2
    spark.catalog.dropTempView(name)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    assert publish(df, name, mode="parquet", path=path, partition_by=["k"]).count() == 2
    with pytest.raises(ValueError):
        publish(df, name, mode="parquet")


def test_views_of_a_query_do_not_stay(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert s7(spark, SF).count() > 0
    assert {t.name for t in spark.catalog.listTables()} <= before


def test_as_of_defaults_to_today(spark):
    day = dt.date.today() - dt.timedelta(days=10)
    got = spark.createDataFrame([(day,)], "d date").select(X.days_since("d", None).alias("n"), X.as_of_date(None).alias("t")).first()
    assert got["n"] in (10, 11) and abs((got["t"] - dt.date.today()).days) <= 1
    assert M.listing_mart(domain_sources(spark, SF)).count() > 0


def test_number_text_and_bool(spark):
    numbers = {12345678.5: "12345678.5", 0.0001: "0.0001", 1e15: "1e+15", 1e14: "100000000000000", 5.0: "5", -5.25: "-5.25",
               999999999999999.0: "999999999999999", 1e300: "1e+300", 1.5e-7: "1.5e-07", -1e7: "-10000000", 100.0: "100",
               1234567.125: "1234567.125", 0.00099: "0.00099", 9.9e-5: "9.9e-05", -2.5e-300: "-2.5e-300", 0.001: "0.001",
               1e22: "1e+22", -1.25e19: "-1.25e+19", 1234567890123456.0: "1234567890123456", 99999999.25: "99999999.25",
               12345678901234568.0: "12345678901234568", 0.1 + 0.2: "0.30000000000000004", 250.0: "250", 499.99: "499.99"}
    for x, t in numbers.items():  # C's own printing
        assert t == (f"{x:.15g}" if float(f"{x:.15g}") == x else f"{x:.17g}")
    signed = spark.sql("SELECT -0.0D AS x UNION ALL SELECT 0.0D UNION ALL SELECT double('-Infinity') UNION ALL SELECT double('NaN')")
    assert sorted(r["t"] for r in signed.select(X.number_text("x").alias("t")).collect()) == ["-inf", "0", "0", "NaN"]
    df = spark.createDataFrame([(k,) for k in numbers] + [(None,)], "x double")
    assert {r["x"]: r["t"] for r in df.select("x", X.number_text("x").alias("t")).collect()} == numbers | {None: None}
    plan = df.select(X.number_text("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("x#") <= 40  # the input is named a bounded number of times, and cast to text in one place a kind
    texts = {"true": True, "FALSE": False, "True": True, "yes": None, "1": None, "t": None, "no": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in texts], "x string")
    assert {r["x"]: r["b"] for r in df.select("x", X.to_bool("x").alias("b")).collect()} == texts


def test_landlord_id_comes_from_the_landlord_table(spark):
    src = domain_sources(spark, SF)
    alone = {r[0] for r in src.bookings.join(src.landlords, "landlord_id", "left_anti").select("booking_id").collect()}
    assert alone
    for spec, empty in ((M.M1, True), (M.M8C, True), (M.M8, False)):
        got = M.booking_mart(src, spec, AS_OF).where(F.col("prd_bookingid").isin(sorted(alone)[:50])).select("landlord_id").collect()
        assert got and all((r[0] is None) == empty for r in got)


def test_oracle_labels_are_stated_apart(monkeypatch):
    """The package's labels equal the oracle's own statement of them."""
    from recomart.functions import labels as L
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "oracles", "labels.json"), encoding="utf-8") as f:
        stated = json.load(f)

    def plain(v):
        return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v

    assert {k: plain(getattr(L, k)) for k in stated} == stated


def test_checkpoint_folder_is_never_made_up_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
