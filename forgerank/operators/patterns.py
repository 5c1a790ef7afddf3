"""Substring search with a dictionary that is a table (J7, F10 for patterns as data).

``text contains pattern`` is no equi join. Each pattern is filed here under one of its
own q-grams, the one that the fewest texts hold, and each text is looked up under its
distinct q-grams; what meets is verified with ``contains``. A pattern of fewer than ``q``
characters is filed under itself, and texts are looked up under their substrings of that
length too. So every match meets exactly once, no text meets a pattern with which it
shares no gram, and neither side is broadcast by force or joined by a nested loop.

Texts are matched once per distinct value. The grams of all texts are narrowed to those
that the dictionary holds before they are counted or joined.

Defined results: a null text or pattern matches nothing; the empty pattern matches every
text; repeated patterns count once; matching is by characters as they are, so callers
lower both sides where the case shall not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared

Q = 3


def grams(text: Column, length: Column) -> Column:
    """Distinct substrings of ``length`` characters; the empty one for length 0."""
    last = F.length(text) - length
    return F.array_distinct(F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.when(length > 0, last).otherwise(0)),
        lambda i: text.substr(i + 1, length))).otherwise(F.array().cast("array<string>")))


def contains_pairs(texts: DataFrame, patterns: DataFrame, text: str = "text", pattern: str = "pattern",
                   q: int = Q) -> DataFrame:
    """Distinct (text, pattern) with ``text`` containing ``pattern``."""
    t = texts.select(F.col(text).alias("text")).where("text is not null").distinct()
    p = patterns.select(F.col(pattern).alias("pattern")).where("pattern is not null").distinct()
    size = F.least(F.length("pattern"), F.lit(q))
    p = shared(p.withColumn("len", size), "patterns")
    # At most q + 1 lengths, whatever the dictionary's size.
    lengths = [r["len"] for r in p.select("len").distinct().collect()]
    if not lengths:
        return t.limit(0).withColumn("pattern", F.lit(None).cast("string"))
    filed = p.select("pattern", F.explode(grams(F.col("pattern"), F.col("len"))).alias("gram"))
    looked = t.select("text", F.explode(F.flatten(F.array(*[grams(F.col("text"), F.lit(n)) for n in lengths]))).alias("gram"))
    looked = shared(looked.join(filed.select("gram").distinct(), "gram", "left_semi"), "text_grams")
    seen = looked.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A pattern with a gram that no text holds matches nothing: the left join keeps n = 0.
    rarest = (filed.join(seen, "gram", "left").groupBy("pattern")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram").alias("gram"))).alias("g"))
              .where("g.n > 0").select("pattern", F.col("g.gram").alias("gram")))
    return looked.join(rarest, "gram").where(F.col("text").contains(F.col("pattern"))).select("text", "pattern")


# J7 ------------------------------------------------------------------------------------
def categorize_by_dictionary(repos: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``analysis.categorize_substring`` with the dictionary as a table (``position``,
    ``category``, ``keyword``): categories in the order of their least position. They
    depend on topics and language alone, so each distinct pair of these is judged once."""
    values = repos.select(F.col("topics").alias("__t"), F.col("primary_language").alias("__l")).distinct()
    lang = F.when(F.col("__l") != "", F.array(F.col("__l")))
    none = F.array().cast("array<string>")
    words = values.select("__t", "__l", F.explode(F.array_distinct(F.transform(
        F.concat(F.coalesce("__t", none), F.coalesce(lang, none)), F.lower))).alias("__w"))
    words = shared(words, "words")
    pairs = contains_pairs(words, dictionary, "__w", "keyword")
    order = dictionary.groupBy("category").agg(F.min("position").alias("position"))
    named = (pairs.join(dictionary.select(F.col("keyword").alias("pattern"), "category"), "pattern")
             .select(F.col("text").alias("__w"), "category").distinct().join(order, "category"))
    hits = (words.join(named, "__w").groupBy("__t", "__l")
            .agg(F.array_sort(F.collect_set(F.struct("position", "category"))).alias("__c"))
            .select(F.col("__t").alias("__ht"), F.col("__l").alias("__hl"), F.col("__c.category").alias("categories")))
    out = repos.join(hits, F.col("topics").eqNullSafe(F.col("__ht")) & F.col("primary_language").eqNullSafe(F.col("__hl")), "left")
    return out.drop("__ht", "__hl").withColumn("categories", F.coalesce("categories", none))


# F10 -----------------------------------------------------------------------------------
def regions_of(board: DataFrame, dictionary: DataFrame, location: str = "location") -> DataFrame:
    """Rows with each ``region`` of the dictionary (``region``, ``pattern``) that their
    lower-cased location lies in, one row a region; rows of no region are left out."""
    where = F.lower(location)
    found = contains_pairs(board.select(where.alias("__w")), dictionary, "__w", "pattern")
    named = (found.join(dictionary.select("pattern", "region"), "pattern")
             .select(F.col("text").alias("__where"), "region").distinct())
    return board.withColumn("__where", where).join(named, "__where").drop("__where")
