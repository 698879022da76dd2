"""Operator properties: unnest edge rows, STRING_AGG, and the skew-safe full join."""

import random
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recomart.operators.aggregate import regroup_string_agg, string_agg
from recomart.operators.joins import left_join_split
from recomart.operators.reconcile import full_outer_reconcile
from recomart.operators.unnest import explode_keep_empty, explode_primary
from recomart.sources.schemas import PERSON


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_primary_unnest_edge_rows(spark):
    data = [(1, None), (2, {"email": None}), (3, {"email": []}), (4, {"email": [("a", False)]}),
            (5, {"email": [("a", True), ("b", True)]}), (6, {"email": [("c", None), ("d", True)]})]
    df = spark.createDataFrame(data, f"id long, person_id {PERSON.simpleString()}")
    got = sorted(tuple(r) for r in explode_primary(df).select("id", "email").collect())
    assert got == [(5, "a"), (5, "b"), (6, "d")]


def test_outer_unnest_keeps_parent(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["x", None])], "id long, arr array<string>")
    got = sorted(explode_keep_empty(df, "arr", "c").select("id", "c").collect(), key=lambda r: (r[0], r[1] or ""))
    assert [tuple(r) for r in got] == [(1, None), (2, None), (3, None), (3, "x")]


def test_string_agg_null_not_empty(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b"), (2, "a"), (2, None)], "k long, c string")
    got = dict(tuple(r) for r in df.groupBy("k").agg(string_agg("c").alias("s")).collect())
    assert got == {1: None, 2: "a,b"}
    arr = spark.createDataFrame([(1, None), (1, []), (2, ["b", None]), (2, ["a"]), (3, ["z"]), (3, ["z"])],
                                "k long, arr array<string>")
    got = dict(tuple(r) for r in regroup_string_agg(arr, ["k"], "arr", "s").collect())
    assert got == {1: None, 2: "a,b", 3: "z,z"}


keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"]))


@settings(max_examples=12, deadline=None)
@given(left=st.lists(st.tuples(keys, st.integers(0, 3)), max_size=40),
       right=st.lists(st.tuples(keys, st.integers(0, 3)), max_size=40))
def test_joins_equal_plain_joins(spark, left, right):
    l_df = spark.createDataFrame(left, "lk string, lv long")
    r_df = spark.createDataFrame(right, "rk string, rv long")
    expected = rows(l_df.join(r_df, F.col("lk") == F.col("rk"), "full"))
    assert rows(full_outer_reconcile(l_df, r_df, "lk", "rk")) == expected
    assert rows(left_join_split(l_df, r_df, "lk", "rk")) == rows(l_df.join(r_df, F.col("lk") == F.col("rk"), "left"))


def test_reconcile_hot_copies_and_nulls(spark):
    rnd = random.Random(7)
    left = [("hot", 1)] * 300 + [(None, 2)] * 50 + [(k, rnd.randint(0, 5)) for k in "abcdef" for _ in range(3)]
    right = [("hot", 9)] * 40 + [("hot", 8)] * 5 + [(None, 3)] * 20 + [("a", 1), ("only_r", 4)] * 3
    left += [("l123", 1), ("r1", 2), ("=", 3), ("", 4)]  # keys that look like the tags of NULL rows
    right += [("l123", 1), ("=", 3), ("", 5)]
    l_df = spark.createDataFrame(left, "lk string, lv long")
    r_df = spark.createDataFrame(right, "rk string, rv long")
    expected = rows(l_df.join(r_df, F.col("lk") == F.col("rk"), "full"))
    assert rows(full_outer_reconcile(l_df, r_df, "lk", "rk")) == expected
    # a key source with the same key set gives the same rows
    got = full_outer_reconcile(l_df, r_df, "lk", "rk", right_keys=r_df.select("rk").distinct())
    assert rows(got) == expected


def test_reconcile_with_nested_columns(spark):
    def srows(df):
        return Counter(repr(tuple(r)) for r in df.collect())

    left = spark.createDataFrame([("a", [("x", True)]), (None, None)],
                                 "lk string, lnest array<struct<value:string,primary:boolean>>")
    right = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "rk string, rv long")
    expected = srows(left.join(right, F.col("lk") == F.col("rk"), "full"))
    assert srows(full_outer_reconcile(right, left, "rk", "lk")) == srows(
        right.join(left, F.col("rk") == F.col("lk"), "full"))
    assert srows(full_outer_reconcile(left, right, "lk", "rk")) == expected
