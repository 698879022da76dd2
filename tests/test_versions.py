"""Publishing by version: one name, atomic switch, failed writes, retention."""

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from recomart.plans.inventory import s8
from recomart.session import ensure_checkpoint_dir
from recomart.sources.versions import VersionStore, publish_version

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark):
    return VersionStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/versions-{uuid.uuid4().hex}")


@pytest.fixture
def name(store):
    n = f"mart_{uuid.uuid4().hex}"
    yield n
    store.unpublish(n)


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()))


def test_versions_follow_one_another(spark, store, name):
    first = store.publish(spark.createDataFrame([(1, "a")], "k long, v string"), name)
    store.publish(spark.createDataFrame([(2, "b"), (3, None)], "k long, v string"), name)
    assert rows(spark, name) == [(2, "b"), (3, None)]
    assert sorted(map(tuple, first.collect())) == [(1, "a")]  # a resolved plan keeps its version
    store.publish(spark.createDataFrame([(4, 0.5, True)], "k long, x double, y boolean"), name)  # other columns
    assert rows(spark, name) == [(4, 0.5, True)]
    assert [v.number for v in store.versions(name)] == [2, 3] and all(v.complete for v in store.versions(name))
    assert rows(spark, name) == sorted(map(tuple, store.roll_back(name, 3).collect()))
    store.roll_back(name, 2)
    assert rows(spark, name) == [(2, "b"), (3, None)]
    store.publish(spark.range(1), name, keep=1)
    assert [v.number for v in store.versions(name)] == [4]
    with pytest.raises(ValueError, match="not kept"):
        store.roll_back(name, 2)


def test_failed_write_leaves_the_old_version(spark, store, name):
    store.publish(spark.range(3), name)
    before = store.current(name)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.publish(bad, name)
    assert store.current(name) == before and rows(spark, name) == [(0,), (1,), (2,)]
    assert len(store.versions(name)) == 1


def test_incomplete_versions_are_never_switched_to(spark, store, name):
    store.publish(spark.range(2), name)
    dead = f"{store.folder}/{name}.versions/v00000002-00000000"
    os.makedirs(dead.removeprefix("file:"))
    half = [v for v in store.versions(name) if not v.complete]
    assert len(half) == 1
    with pytest.raises(ValueError, match="not complete"):
        store.switch(name, half[0])
    store.publish(spark.range(5), name)
    assert [v.number for v in store.versions(name)] == [1, 2, 3]      # it may still be written
    store.drop_old(name, keep=1, stale_hours=-1.0)
    assert [v.number for v in store.versions(name)] == [3] and len(rows(spark, name)) == 5


def test_two_writers_never_mix(spark, store, name):
    errors = []

    def write(n):
        try:
            assert store.publish(spark.range(n), name, keep=4).count() in (10, 20, 30)
        except Exception as e:
            errors.append(e)

    writers = [threading.Thread(target=write, args=(n,)) for n in (10, 20, 30)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not errors and len(rows(spark, name)) in (10, 20, 30) and len(store.versions(name)) == 3


def test_other_tables_are_not_replaced(spark, store):
    taken = f"taken_{uuid.uuid4().hex}"
    spark.range(1).write.saveAsTable(taken)
    try:
        with pytest.raises(ValueError, match="not published by version"):
            store.publish(spark.range(2), taken)
        with pytest.raises(ValueError, match="plain table name"):
            store.publish(spark.range(2), "a.b; DROP")
        with pytest.raises(ValueError, match="at least"):
            publish_version(spark.range(2), "x", keep=0)
    finally:
        spark.sql(f"DROP TABLE {taken}")


def test_s8_leaves_one_name(spark):
    before = {t.name for t in spark.catalog.listTables()}
    first = s8(spark, SF)
    second = s8(spark, SF)
    assert {t.name for t in spark.catalog.listTables()} - before <= {"landlord_listings"}
    assert spark.catalog.tableExists("landlord_listings")
    assert first.count() == second.count() == spark.table("landlord_listings").count() > 0
    store = VersionStore(spark)
    assert len(store.versions("landlord_listings")) <= 2
