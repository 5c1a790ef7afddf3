"""Substring dictionaries as tables against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from forgerank.functions import dictionaries as D
from forgerank.operators import analysis as AN
from forgerank.operators import patterns as P
from forgerank.operators import ranking as R


@pytest.mark.parametrize("q", [1, 2, 3, 5])
def test_pairs_equal_a_plain_search(spark, q):
    r = random.Random(q)

    def word(n):
        return "".join(r.choice("ab\u00e9\U0001f600 .*%_") for _ in range(n))

    texts = [word(r.randrange(0, 40)) for _ in range(150)] + [None, "", "ab" * 5000] * 2
    patterns = [word(r.randrange(0, 9)) for _ in range(200)] + [None, "", "ab" * 2000, "zzz", "a", "a"]
    t = spark.createDataFrame([(x,) for x in texts], "text string")
    p = spark.createDataFrame([(x,) for x in patterns], "pattern string")
    got = [tuple(x) for x in P.contains_pairs(t, p, q=q).collect()]
    want = {(a, b) for a in texts if a is not None for b in patterns if b is not None and b in a}
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_sides(spark):
    t = spark.createDataFrame([("abc",)], "text string")
    p = spark.createDataFrame([("b",)], "pattern string")
    assert P.contains_pairs(t, p.limit(0)).columns == ["text", "pattern"]
    assert P.contains_pairs(t, p.limit(0)).count() == P.contains_pairs(t.limit(0), p).count() == 0


def test_a_pattern_is_filed_under_its_rarest_gram(spark):
    """Every text holds the pattern's first grams, one holds its last: one row is verified."""
    t = spark.createDataFrame([(f"common {k}",) for k in range(500)] + [("common xyz",)], "text string")
    p = spark.createDataFrame([("common xyz",)], "pattern string")
    df = P.contains_pairs(t, p)
    assert df.count() == 1
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Join Inner, " in plan


def test_categories_equal_the_literal_form(spark):
    rows = [("a", ["Email"], None), ("b", ["django"], "Go"), ("c", None, None), ("d", [], ""), ("e", [None, "UI"], "Python"),
            ("e", [None, "UI"], "Python"), ("f", ["x" * 3000 + "spark"], "Sql"), (None, ["ml", "data"], "R")]
    df = spark.createDataFrame(rows, "owner_login string, topics array<string>, primary_language string")
    words = [(i, c, k) for i, (c, kws) in enumerate(D.CATEGORIES_SUBSTRING.items()) for k in kws]
    d = spark.createDataFrame(words, "position int, category string, keyword string")
    want = sorted(map(str, AN.categorize_substring(df).collect()))
    assert sorted(map(str, P.categorize_by_dictionary(df, d).collect())) == want
    assert P.categorize_by_dictionary(df, d.limit(0)).where(F.size("categories") > 0).count() == 0


def test_regions_equal_the_literal_form(spark):
    rows = [(k, x) for k, x in enumerate(["Mansfield", "Louisville", "Latin America", "Bay Area, CA", None, "", "Berlin", "Berlin"])]
    df = spark.createDataFrame(rows, "id int, location string")
    d = spark.createDataFrame([("bay", p) for p in D.BAY_AREA_PATTERNS] + [("de", "berlin"), ("de", "germany")], "region string, pattern string")
    got = P.regions_of(df, d).collect()
    assert sorted(r.id for r in got if r.region == "bay") == sorted(r.id for r in R.region_members(df).collect())
    assert sorted(r.id for r in got if r.region == "de") == [6, 7]
