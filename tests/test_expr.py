"""Edge rows of every business expression (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from recomart.functions import expr as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def run(spark, values, fn, typ="string"):
    return [r[0] for r in one_col(spark, values, typ).select(fn(F.col("x"))).collect()]


def test_duration_labels_both_languages_and_default(spark):
    vals = ["Less than one month", "Einen Monat", "Länger als sechs Monate", "foo", None]
    assert run(spark, vals, X.rent_duration_class) == ["<1 mo", "1 mo", ">6 mo", "undefined", "undefined"]
    assert run(spark, vals, X.rent_duration_typical_nights) == [15, 30, 200, 0, 0]
    assert run(spark, vals, X.rent_duration_min_nights) == [1, 30, 181, 0, 0]
    assert run(spark, vals, X.rent_duration_max_nights) == [29, 30, 360, 0, 0]


def test_rent_unsure_kept_or_null(spark):
    vals = ["I'm unsure", "Kostenlos", "über 500€ pro Monat", None]
    assert run(spark, vals, X.rent_per_person_class) == ["unsure", "for_free", ">500 mo", "undefined"]
    assert run(spark, vals, lambda c: X.rent_per_person_class(c, True)) == [None, "for_free", ">500 mo", "undefined"]
    assert run(spark, vals, X.rent_per_person_number) == [None, 0, 1000, 0]


def test_pets_answers(spark):
    vals = ["Vielleicht", "No", "Ja", "x", None]
    assert run(spark, vals, X.pets_answer) == ["maybe", "no", "yes", "undefined", "undefined"]
    assert run(spark, vals, X.pets_bool) == [None, False, True, None, None]
    assert run(spark, vals, X.pets_flag) == [0, 0, 1, 0, 0]


def test_has_pets_rules_literal_vs_like(spark):
    vals = ["none at all", "", None, "%no %", "No Cats", "i don't have"]
    # literal IN: wildcards are not applied, NULL and '' fall to ELSE (yes)
    assert run(spark, vals, lambda c: X.has_pets(c, "literal")) == [True, True, True, False, True, True]
    # rule C: lower LIKE '%no %' / '%without' / 'none%'
    assert run(spark, vals, lambda c: X.has_pets(c, "like_c")) == [False, True, True, False, False, True]
    # rule D: '%no%' / '%without%' / '%don%' / ''
    assert run(spark, vals, lambda c: X.has_pets(c, "like_d")) == [False, False, True, False, False, False]


def test_disability_rules(spark):
    vals = ["wheelchair", "without", "nobody", "", None, "I don't know"]
    assert run(spark, vals, lambda c: X.has_disability(c, "literal")) == [1, 1, 1, 1, 1, 1]
    assert run(spark, vals, lambda c: X.has_disability(c, "like_b")) == [1, 0, 0, 1, 1, 0]
    assert run(spark, vals, lambda c: X.has_disability(c, "like_c")) == [1, 0, 0, 0, 1, 0]


def test_nights_spent_null_stays_null(spark):
    df = spark.createDataFrame([("2000-07-10",), ("2000-06-01",), (None,)], "d string").select(
        F.col("d").cast("date").alias("d"))
    got = [r[0] for r in df.select(X.nights_spent_floored("d", "2000-06-30")).collect()]
    assert got == [0, 29, None]


def test_stay_class_hole_at_90(spark):
    nights = [29, 30, 31, 89, 90, 91, 179, 180, None]
    df = spark.createDataFrame([(n,) for n in nights], "n long")
    got = [r[0] for r in df.select(X.stay_class(F.lit(None).cast("string"), F.col("n"))).collect()]
    assert got == ["<1 mo", "1 mo", "1-3 mo", "1-3 mo", None, "3-6 mo", "3-6 mo", ">6 mo", None]
    got = [r[0] for r in df.select(X.stay_class(F.lit(">6 mo"), F.col("n"))).collect()]
    assert set(got) == {">6 mo"}
    gated = [r[0] for r in df.select(X.stay_class_gated(F.lit(None).cast("string"), F.lit("x"), F.col("n"))).collect()]
    assert gated[4] == "Unknown" and gated[-1] == "Unknown"


def test_price_class_edges(spark):
    prices = [None, -1.0, 0.0, 249.0, 250.0, 499.0, 500.0]
    assert run(spark, prices, X.price_class, "double") == [
        None, "<250 mo", "for_free", "<250 mo", "250-500 mo", "250-500 mo", ">500 mo"]


def test_needed_months_code_points_and_like(spark):
    vals = ["3-6 months ", "3-6 months", "1–3 мonths", "1-3 months", "I don't know", "indefinitely",
            "less than a month", "random", None, "I don't know, indefinite"]
    assert run(spark, vals, X.needed_months_class) == [
        "3-6 mo", "3-6 mo", "1-3 mo", "1-3 mo", "Unknown", ">6 mo", "1 mo", "Unknown", "Unknown", "Unknown"]
    classes = ["<1 mo", "1 mo", "1-3 mo", "3-6 mo", ">6 mo", "Unknown"]
    assert run(spark, classes, X.needed_months_nights) == [15, 30, 60, 120, 360, 0]


def test_merge_rules(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2, None), (None, None, "b")], "pd long, prd long, g string")
    rows = df.select(X.source_flag("pd", "prd"), X.prefer("prd", "pd"), X.when_present("g", "prd"),
                     X.by_presence("prd", F.lit("P"), "pd", F.lit("C"))).collect()
    assert [tuple(r) for r in rows] == [
        ("in_pipedrive_only", 1, None, "C"), ("in_product_only", 2, None, "P"), (None, None, None, None)]


def test_number_text_whole_numbers(spark):
    assert run(spark, [100.0, 12.5, None, -3.0], X.number_text, "double") == ["100", "12.5", None, "-3"]


def test_flag_from_truth_first_true_wins(spark):
    df = spark.createDataFrame([(True, None, None), (None, True, None), (None, None, True), (None, None, None)],
                               "a boolean, b boolean, c boolean")
    got = [r[0] for r in df.select(X.flag_from_truth("a", "b", "c")).collect()]
    assert got == ["in_product_only", "in_pipedrive_only", "both_sources", None]


def test_needed_months_by_dictionary_join(spark):
    from recomart.functions import labels as L
    from recomart.plans.deals import with_needed_months
    answers = [k for k, _ in L.NEEDED_MONTHS_EQUALS] + ["", "no idea", "more than 6", None, "O'Neill \\\\ 3", "1 "] * 2
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i long, a string")
    got = {r["i"]: r["c"] for r in with_needed_months(df, "a", "c").collect()}
    want = {r["i"]: r["c"] for r in df.select("i", X.needed_months_class("a").alias("c")).collect()}
    assert got == want and len(got) == len(answers) and len(set(want.values())) >= 5


def test_dictionary_lookup(spark, monkeypatch):
    from recomart.operators import lookup
    df = spark.createDataFrame([("a",), ("b'\\\\",), (None,), ("A",), ("a",)], "k string")
    pairs = [("a", "1"), ("b'\\\\", "2")]
    for limit in (10, 1):  # sent to all tasks, or left to the planner
        monkeypatch.setattr(lookup, "BROADCAST_ENTRIES", limit)
        got = lookup.with_lookup(df, "k", pairs, "v", lambda v: F.coalesce(v, F.lit("none")))
        assert sorted((r["k"] or "", r["v"]) for r in got.collect()) == [
            ("", "none"), ("A", "none"), ("a", "1"), ("a", "1"), ("b'\\\\", "2")]
        assert ("BroadcastHint" in got._jdf.queryExecution().analyzed().toString() or "strategy=broadcast" in
                got._jdf.queryExecution().analyzed().toString()) == (limit == 10)
    assert lookup.with_lookup(df, "k", [], "v").where("v IS NULL").count() == 5
    with pytest.raises(ValueError, match="twice"):
        lookup.with_lookup(df, "k", [("a", "1"), ("a", "2")], "v")
