"""Skewed inputs: one plan at every size, hot keys split by AQE, every side read once."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recomart.operators.reconcile import full_outer_reconcile
from recomart.plans import marts as M
from recomart.plans.inventory import AS_OF
from recomart.plans.product import enriched_bookings
from recomart.plans.staging import stage
from recomart.session import ensure_checkpoint_dir
from recomart.sources.adapter import domain_sources

SF = "/root/testdata/sf0.001"
HOT = "user1@mail.example"


@pytest.fixture
def small_partitions(spark):
    """Join sizes at which AQE sees skew in small test tables."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shape(plan: str) -> list[str]:
    """Names of the joins and scans of a plan."""
    return sorted(re.findall(r"(\w*Join\w*(?:\(skew=true\))?|Scan parquet|ReusedExchange)", plan))


def skewed_sources(spark):
    """A third of the landlords share one e-mail."""
    s = domain_sources(spark, SF)
    third = F.substring("landlord_id", -1, 1).cast("long") % 3 == 1
    s.landlords = s.landlords.withColumn(
        "freshworks_email", F.when(third, F.lit(HOT)).otherwise(F.col("freshworks_email")))
    return s


def test_hot_landlord_email_equals_plain_join(spark):
    src = skewed_sources(spark)
    left = M._pfx(M.crm_bookings(src, M.M1, AS_OF), "pd__")
    right = M._pfx(enriched_bookings(src, AS_OF, "landlord"), "prd__")
    plain = rows(left.join(right, F.col("pd__email") == F.col("prd__email"), "full"))
    assert rows(full_outer_reconcile(left, right, "pd__email", "prd__email")) == plain
    n_hot = right.where(F.col("prd__email") == HOT).count()
    assert n_hot * 4 > right.where(F.col("prd__email").isNotNull()).count()


def test_skewed_mart_takes_the_plan_of_an_even_one(spark):
    def logical(src):
        plan = M.booking_mart(src, M.M1, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
        return re.findall(r"Join \w+|Union|Aggregate|Relation", plan)

    folder = ensure_checkpoint_dir(spark).rstrip("/")
    even = domain_sources(spark, SF).materialize(f"{folder}/even")
    skewed = skewed_sources(spark).materialize(f"{folder}/skewed")
    assert logical(even) == logical(skewed)


def test_mart_reads_each_side_once(spark, small_partitions):
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    src = stage(domain_sources(spark, SF), f"{folder}/once")
    plan = final_plan(M.booking_mart(src, M.M1, AS_OF))
    final = plan.split("== Initial Plan ==")[0]
    wide = [x for x in re.findall(r"Scan parquet [^\n]*ReadSchema: struct<([^>]*)", final) if "booking_id" in x]
    assert len(wide) == 1 and "ReusedExchange" in final


def test_hot_listing_is_split(spark, small_partitions):
    src = domain_sources(spark, SF)
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    hot = src.bookings.withColumn("listing_id", F.when(F.col("booking_id").like("%-1"), F.lit("7")).otherwise(F.col("listing_id")))
    hot.repartition(8).write.mode("overwrite").parquet(f"{folder}/hot_bookings")
    src.bookings = spark.read.parquet(f"{folder}/hot_bookings")
    df = enriched_bookings(src, AS_OF, "landlord")
    assert "skew=true" in final_plan(df)
    src.booking_id_is_key = True  # as staging finds it: the plain plan
    plain = enriched_bookings(src, AS_OF, "landlord")
    assert "skew=true" in final_plan(plain) and rows(plain) == rows(df)


def test_hot_key_of_the_full_join_is_split_on_both_sides(spark, small_partitions):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), "id")).alias("lk"),
                                    F.col("id").alias("lv")).repartition(6)
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), "id")).alias("rk"),
                                    F.md5(F.col("id").cast("string")).alias("rv")).repartition(6)
    got = full_outer_reconcile(left, right, "lk", "rk")
    assert "SortMergeJoin(skew=true)" in final_plan(got)
    assert got.count() == left.join(right, F.col("lk") == F.col("rk"), "full").count()
