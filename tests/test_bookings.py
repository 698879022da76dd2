"""Bookings with repeated and NULL ids against the source's plain self-join, and the staged booking models."""

import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recomart.plans import marts as M
from recomart.plans.inventory import AS_OF
from recomart.plans.product import LISTING_COLS, booking_contact_keys, booking_model, enriched_bookings, repeated_bookings
from recomart.plans.staging import is_key, stage
from recomart.session import ensure_checkpoint_dir
from recomart.sources.adapter import domain_sources

SF = "/root/testdata/sf0.001"
BOOKING_MARTS = ("m1", "m2", "m8", "m8b", "m8c", "m8d")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bookings-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def repeated(spark):
    """Sources in which ids repeat (up to a hot one), are NULL, and listings occur twice in either catalogue."""
    src = domain_sources(spark, SF)
    bk = src.bookings.where(F.crc32("booking_id") % 8 == 0)
    n = F.crc32("booking_id")
    ids = (F.when(n % 7 == 0, F.lit("hot")).when(n % 11 == 0, F.lit(None).cast("string"))
           .when(n % 5 == 0, F.substring("booking_id", 1, 3)).otherwise(F.col("booking_id")))
    bk = bk.withColumn("booking_id", ids)
    bk = bk.unionByName(bk.where("listing_id is not null").limit(5).withColumn("listing_id", F.lit("nowhere")))
    path = folder(spark)
    bk.write.parquet(path)
    src.bookings = spark.read.parquet(path)
    src.core_listings = src.core_listings.unionByName(src.core_listings.where(F.crc32("listing_id") % 9 == 0))
    src.listings = src.listings.unionByName(src.listings.where(F.crc32("listing_id") % 10 == 0))
    return src


def plain_model(src, contact, core_first):
    """The source's joins one after the other."""
    bk = src.bookings
    core = src.core_listings.select(*LISTING_COLS).toDF(*["core_" + c for c in LISTING_COLS])
    rfg = src.listings.select(*LISTING_COLS).toDF(*["rfg_" + c for c in LISTING_COLS])
    pairs = src.listing_requests.select("listing_id", "pets_allowed").distinct().toDF("lr_listing_id", "lr_pets_allowed")
    driver = bk.select(F.col("booking_id").alias("d_id"), F.col("listing_id").alias("d_lid"),
                       F.col("booked_from").alias("driver_booked_from"))
    driver = driver.join(core, F.col("d_lid") == F.col("core_listing_id"), "left" if core_first else "inner")
    if core_first:
        j = driver.join(bk, F.col("d_id") == F.col("booking_id"), "left")
    else:
        j = bk.join(driver.drop("driver_booked_from"), F.col("booking_id") == F.col("d_id"), "left")
    j = j.join(rfg, F.col("listing_id") == F.col("rfg_listing_id"), "left")
    j = j.join(pairs, F.col("rfg_listing_id") == F.col("lr_listing_id"), "left")
    if contact == "landlord":
        dim = src.landlords.select(F.col("landlord_id").alias("contact_id"), F.col("freshworks_email").alias("contact"))
        return j.join(dim, F.col("landlord_id") == F.col("contact_id"), "left")
    dim = src.users.select(F.col("user_id").alias("contact_id"), F.col("email").alias("contact"))
    return j.join(dim, F.col("tenant_id") == F.col("contact_id"), "left")


@pytest.mark.parametrize("contact,core_first", [("landlord", False), ("tenant", False), ("landlord", True)])
def test_repeated_ids_equal_the_plain_self_join(spark, repeated, contact, core_first):
    plain = plain_model(repeated, contact, core_first)
    got = booking_model(repeated, contact, core_first)
    names = [c for c in got.columns if c in plain.columns and c != "core_listing_id"]
    assert len(names) > 40 and (not core_first or "driver_booked_from" in names)
    assert rows(got.select(*names)) == rows(plain.select(*names))
    keys = {r[0] for r in booking_contact_keys(repeated, contact, core_first).distinct().collect()} - {None}
    assert keys == {r[0] for r in got.select("contact").distinct().collect()} - {None}
    with pytest.raises(ValueError):
        booking_model(repeated, "nobody")


def test_repeated_ids_are_there(repeated):
    hot = repeated_bookings(repeated).groupBy("booking_id").count().collect()
    assert len(hot) > 3 and max(r["count"] for r in hot) > 50
    assert repeated.bookings.where("booking_id is null").count() > 5 and not is_key(repeated)


def test_staged_models_of_repeated_ids(spark, repeated):
    staged = stage(repeated, folder(spark))
    assert not staged.booking_id_is_key and len(staged.booking_models) == 3
    for name in ("m1", "m2", "m8"):
        assert rows(M.MARTS[name](staged, AS_OF)) == rows(M.MARTS[name](repeated, AS_OF))


def scans(plan):
    """Columns read by every Parquet scan of a final plan."""
    final = plan.split("== Initial Plan ==")[0]
    return [set(re.findall(r"(\w+):", x)) for x in re.findall(r"Scan parquet [^\n]*ReadSchema: struct<([^\n]*)>", final)]


@pytest.fixture
def large_plans(spark):
    """Plans as for large tables (no side is broadcast), whose scans show their whole schema."""
    conf = {"spark.sql.maxMetadataStringLength": "4000", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_marts_start_from_the_staged_models(spark, large_plans):
    plain = domain_sources(spark, SF)
    staged = stage(plain, folder(spark))
    assert staged.booking_id_is_key and len(staged.booking_models) == 3
    for name in BOOKING_MARTS:
        mart = M.MARTS[name](staged, AS_OF)
        assert rows(mart) == rows(M.MARTS[name](plain, AS_OF))
        plan = mart._jdf.queryExecution().executedPlan().toString()
        read = scans(plan)
        wide = [c for c in read if "booking_id" in c]
        assert len(wide) == 1 and {"email", "price", "rooms"} <= wide[0], [sorted(c) for c in read]  # the model, once
        assert [c for c in read if c == {"email"}]                            # its keys: one column
        assert not [c for c in read if "listing_id" in c and "booking_id" not in c]  # no catalogue is joined again
        assert len([c for c in read if "won_time" in c]) == 1                 # the wide deals, once


def test_rebinding_a_source_forgets_the_models(spark):
    staged = stage(domain_sources(spark, SF), folder(spark))
    staged.bookings = staged.bookings.limit(10)
    assert not staged.booking_models and not staged.booking_id_is_key
    assert enriched_bookings(staged, AS_OF).count() >= 10


def test_bucketed_listings_are_joined_without_an_exchange(spark, large_plans):
    plain = stage(domain_sources(spark, SF), folder(spark))
    prefix = f"b{uuid.uuid4().hex}_"
    try:
        src = plain.bucket_by_listing(folder(spark), prefix, 4)
        got = booking_model(src, "landlord")
        assert rows(got.select(sorted(got.columns))) == rows(booking_model(plain, "landlord").select(sorted(got.columns)))
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # the only exchanges are those of the join with the contact above
        dealt = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
        assert sorted(dealt) == ["contact_id", "landlord_id"] and plan.count("SelectedBucketsCount") == 4
        assert rows(M.MARTS["m1"](src, AS_OF)) == rows(M.MARTS["m1"](plain, AS_OF))
        src.listings = src.listings.limit(5)
        assert not src.listing_buckets
    finally:
        for name in ("bookings", "listings", "core_listings", "listing_requests"):
            spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_ids_that_cannot_repeat_are_not_searched(spark, large_plans):
    for name in ("m1", "m2", "m8"):
        plan = final_plan(M.MARTS[name](domain_sources(spark, SF), AS_OF))
        assert not re.findall(r"Exchange hashpartitioning\(booking_id#", plan)
        assert len(re.findall(r"Window \[row_number\(\) windowspecdefinition\(l_orderkey", plan)) <= 2  # the rows, and their reuse


def test_pets_answers_are_shuffled_once_per_booking(spark, large_plans):
    src = domain_sources(spark, SF)
    mart = M.booking_mart(src, M.M1, AS_OF)
    plan = final_plan(mart)
    # the answers become rows above the union of the reconciliation's branches
    assert plan.index("explode(prd__pets") < plan.index("Union")
    assert mart.count() > src.bookings.count()


def test_narrow_rules_read_no_listing_values(spark, large_plans):
    mart = M.booking_mart(domain_sources(spark, SF), M.M1, AS_OF).select("source_flag", "pd_id", "prd_bookingid")
    assert not [c for c in scans(final_plan(mart)) if c & {"p_retailprice", "p_size", "p_type"}]


def test_ids_of_rows_without_order_or_line(spark):
    """Ids made of fewer numbers may be those of other such rows: found, and joined as the source does."""
    from recomart.sources import adapter
    src = domain_sources(spark, SF)
    few = spark.read.parquet(f"{SF}/lineitem.parquet").limit(40).where("l_linenumber < 4").select(
        F.lit(3).cast("long").alias("l_orderkey"), F.lit(3).cast("int").alias("l_linenumber"), "l_partkey", "l_suppkey", "l_shipdate")
    none = few.withColumn("l_orderkey", F.lit(None).cast("long"))
    line = few.unionByName(none).unionByName(few.withColumn("l_linenumber", F.lit(None).cast("int"))).unionByName(
        none.withColumn("l_linenumber", F.lit(None).cast("int")))
    path = folder(spark)
    line.write.parquet(path)
    line = spark.read.parquet(path)
    src.bookings = adapter.bookings(line)
    parts = adapter.booking_parts(line)
    assert src.booking_parts is None and rows(parts[0].unionByName(parts[1])) == rows(src.bookings)
    ids = parts[0].select("booking_id")
    assert ids.distinct().count() == ids.count() and ids.intersect(parts[1].select("booking_id")).count() == 0
    src.booking_parts = parts
    assert repeated_bookings(src).count() > 20
    for contact, core_first in (("landlord", False), ("tenant", True)):
        plain = plain_model(src, contact, core_first)
        got = booking_model(src, contact, core_first)
        names = [c for c in got.columns if c in plain.columns and c != "core_listing_id"]
        assert rows(got.select(*names)) == rows(plain.select(*names))


def test_bookings_are_not_dealt_by_email(spark, large_plans):
    """The e-mails are reconciled on the contacts; bookings go to their contact and their listing, unsorted for both."""
    src = domain_sources(spark, SF)
    for name in BOOKING_MARTS:
        final = final_plan(M.MARTS[name](src, AS_OF))
        assert not re.findall(r"Exchange hashpartitioning\(__rk_key#[^\n]*\n[^\n]*booking_id#", final)
        joins = [x for x in re.findall(r"(\w+Join) \[(\w+)#[^\]]*\], \[(\w+)#", final)
                 if x[2] in ("contact_id", "info_listing_id") and x[1] != "contact_id"]
        assert len(joins) == 2 and {x[0] for x in joins} == {"ShuffledHashJoin"}, joins


def test_repeated_and_unbooked_contacts(spark):
    """Contacts that occur twice, have no id, no booking or a shared e-mail: as the staged models' full join gives them."""
    src = domain_sources(spark, SF)
    for name, key, email in (("landlords", "landlord_id", "freshworks_email"), ("users", "user_id", "email")):
        df = getattr(src, name)
        ids = F.crc32(key)
        more = (df.where(ids % 3 == 0).unionByName(df.where(ids % 5 == 0).withColumn(key, F.lit(None).cast("string")))
                .unionByName(df.where(ids % 4 == 0).withColumn(key, F.concat(F.lit("unbooked"), key))))
        shared = F.when(F.crc32(key) % 7 == 0, F.lit("user2@mail.example")).otherwise(F.col(email))
        setattr(src, name, df.unionByName(more).withColumn(email, shared))
    staged = stage(src, folder(spark))
    for name in ("m1", "m2", "m8d"):
        assert rows(M.MARTS[name](src, AS_OF)) == rows(M.MARTS[name](staged, AS_OF))


def test_rules_follow_the_listings_without_a_union(spark, large_plans):
    """Deals without a booking are put to the bookings before the listings are joined, and deals travel as one struct."""
    for name in ("m1", "m8", "m8d"):
        plan = M.MARTS[name](domain_sources(spark, SF), AS_OF)._jdf.queryExecution().executedPlan().toString()
        top, below = plan[plan.index("explode(prd__pets"):].split("ShuffledHashJoin [listing_key", 1)
        assert "Union" not in top
        dealt = re.search(r"Exchange hashpartitioning\(listing_key#[^\n]*\n[^\n]*Union", below)
        assert dealt and "pd__city" not in re.search(r"Project \[[^\n]*contact#[^\n]*deal#[^\n]*", below)[0]


def test_bookings_without_listing_beside_deals_without_booking(spark):
    src = domain_sources(spark, SF)
    path = folder(spark)
    src.bookings.withColumn("listing_id", F.when(F.crc32("booking_id") % 3 > 0, F.col("listing_id"))).write.parquet(path)
    src.bookings = spark.read.parquet(path)
    got, staged = M.MARTS["m8"](src, AS_OF), M.MARTS["m8"](stage(src, folder(spark)), AS_OF)
    assert rows(got) == rows(staged)
    assert {r[0] for r in got.select("source_flag").distinct().collect()} == {
        r[0] for r in staged.select("source_flag").distinct().collect()} and got.where("prd_bookingid is null").count() > 50


def test_few_columns_have_the_rows_of_the_whole_mart(spark):
    src = domain_sources(spark, SF)
    for name, plan in M.FEW_COLUMNS.items():
        assert rows(plan(src, AS_OF)) == rows(M.MARTS[name](src, AS_OF))


def test_few_columns_deal_each_booking_once_for_its_contact(spark, large_plans):
    """Listings first: neither a contact's e-mail nor the rows of its deals are shuffled with the bookings, nor are pets answers
    that nobody reads."""
    src = domain_sources(spark, SF)
    for name, cols in (("m1", ["pd_id", "prd_bookingid", "rooms"]), ("m2", ["pd_id", "prd_bookingid", "distinct_ids"]),
                       ("m8d", ["pd_id", "prd_bookingid", "pd_te_rent_duration_raw"])):
        plan = M.FEW_COLUMNS[name](src, AS_OF, cols).select(*cols)._jdf.queryExecution().executedPlan().toString()
        contact, listing = plan.index("ShuffledHashJoin [landlord_id" if name != "m8d" else "ShuffledHashJoin [tenant_id"), plan.index(
            "ShuffledHashJoin [listing_id")
        assert contact < listing                                  # the plan's last join is its first line
        assert "collect_list" not in plan and "explode(prd__pets" not in plan


def test_few_columns_of_odd_bookings(spark, repeated):
    """Repeated and NULL ids, listings that occur twice, no listing, shared and repeated contacts, no, NULL and several answers."""
    path = folder(spark)
    repeated.bookings.withColumn("listing_id", F.when(F.crc32("listing_id") % 5 > 0, F.col("listing_id"))).write.parquet(path)
    src = domain_sources(spark, SF)
    src.bookings = spark.read.parquet(path)
    src.core_listings, src.listings = repeated.core_listings, repeated.listings
    for name, key, email in (("landlords", "landlord_id", "freshworks_email"), ("users", "user_id", "email")):
        df = getattr(src, name)
        again = df.where(F.crc32(key) % 3 == 0)
        setattr(src, name, df.unionByName(again).withColumn(
            email, F.when(F.crc32(key) % 7 == 0, F.lit("user2@mail.example")).otherwise(F.col(email))))
    answers = src.listing_requests.groupBy("listing_id").agg(F.countDistinct("pets_allowed").alias("n"),
                                                             F.count_if(F.col("pets_allowed").isNull()).alias("none"))
    assert answers.where("n > 1").count() and answers.where("none > 0").count()
    for name, cols in (("m1", ["pd_id", "prd_bookingid", "rooms", "email"]),
                       ("m2", ["pd_id", "prd_bookingid", "distinct_ids", "city", "nights_spent"]),
                       ("m8", ["pd_id", "prd_bookingid", "number_of_tenants"]),
                       ("m8d", ["pd_id", "prd_bookingid", "max_rent_duration_categorical", "pets_allowed"])):
        few = M.FEW_COLUMNS[name](src, AS_OF, cols)
        assert ("pets_allowed" in few.columns) == ("pets_allowed" in cols)
        assert rows(few.select(*cols)) == rows(M.MARTS[name](src, AS_OF).select(*cols))
