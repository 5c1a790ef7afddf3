"""Quality rules with thresholds adapted to each language and source; DataFrame functions only.

Per document: counts over its whole text. Per (lang, source): one quantile sketch a
metric, a histogram over buckets of bounded relative width (a value keeps its top
``BITS`` bits). Such sketches merge by adding counts, so they are built map-side and
shuffled as a few hundred rows a group, and the sketch of a language is the sum of
its sources'. A group's quartiles are blended with its language's, and these with those of
all documents: of n documents they weigh n / (n + ``PRIOR``), for every n, so no size of a
group is a switch. Thresholds are the blended quartiles widened by ``FENCE`` times their
distance and a least margin; documents outside go.

All values are integers (ratios in thousandths), so results do not depend on the order
in which sketches are merged.

Defined results: a null text has no words; a null lang or source is a group of its
own; repeated rows count and are kept like any other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared
from .common import table

# FIXED VALUES
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Parameters of the adaptive thresholds.
BITS = 6
PRIOR = 20
FENCE = 3
# metric -> (numerator, denominator, least margin above, least margin below or None)
METRICS = {
    "symbols": ("n_symbols", "n_words", 200, None),
    "dup_lines": ("n_dup_lines", "n_lines", 300, None),
    "word_length": ("word_chars", "n_words", 4000, 3000),
}


def dropping(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts. Shingles are compared by 64-bit hashes inside the row;
    only texts in which one occurs twice are sorted, to find the words they cover."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: dropping(x, SPACES) != "")
    df = docs.select(
        *keep, F.length(dropping(t, SPACES)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(dropping(t, SYMBOLS))).cast("long").alias("n_symbols"),
        F.transform(lines, lambda x: F.xxhash64(x)).alias("lines"),
        F.transform(F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), ""), lambda x: F.xxhash64(x)).alias("w"))
    df = df.select(
        *keep, "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("w").cast("long").alias("n_words"),
        F.when(F.size("w") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("w") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(WINDOW)]))).alias("g"))
    rest = [*keep, "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_words"]
    df = df.select(*rest, F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(
        F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    df = df.select(*rest, F.sort_array(F.transform(
        F.filter(F.transform("s", lambda x, k: F.struct(
            ((F.get(F.col("s"), k - 1)["h"] == x["h"]) | (F.get(F.col("s"), k + 1)["h"] == x["h"])).alias("twice"),
            x["i"].alias("i"))), lambda x: x["twice"]), lambda x: x["i"])).alias("j"))
    covered = F.aggregate(
        F.transform("j", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("j"), k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return df.select(*rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratio(metric: str) -> Column:
    num, den, _, _ = METRICS[metric]
    return F.expr(f"({num} * 1000) div greatest({den}, 1)")


def bucket(v: Column) -> Column:
    """The value with its top ``BITS`` bits kept: buckets of 2**(1 - BITS) relative width."""
    shift = F.greatest(F.length(F.bin(v)) - BITS, F.lit(0))
    size = F.pow(F.lit(2), shift).cast("long")
    return v - F.pmod(v, size)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n) over documents that pass the base rules."""
    values = F.explode(F.create_map(*[x for m in METRICS for x in (F.lit(m), bucket(ratio(m)))]))
    return (rows.where(~F.col("base_failed")).select("lang", "source", values.alias("metric", "bucket"))
            .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merges the sketches to ``by`` and reads the quartiles: by group, a map of
    (n, q1, q3) by metric."""
    merged = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    hist = (merged.groupBy(*by, "metric")
            .agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("h"), F.sum("n").alias("total")))

    def quantile(k):  # the first bucket at which a quarter (k = 1) or three (k = 3) are reached
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
        return F.aggregate("h", start, lambda a, x: F.struct(
            (a["seen"] + x["n"]).alias("seen"),
            F.coalesce(a["at"], F.when(4 * (a["seen"] + x["n"]) >= k * F.col("total"), x["bucket"])).alias("at")),
            lambda a: a["at"])

    q = F.struct(F.col("total").alias("n"), quantile(1).alias("q1"), quantile(3).alias("q3"))
    return (hist.select(*by, "metric", q.alias("q")).groupBy(*by)
            .agg(F.map_from_entries(F.collect_list(F.struct("metric", "q"))).alias("q")))


def blend(own: Column, parent: Column, q: str) -> Column:
    """Quartile ``q`` of a group of n documents, weighed n / (n + PRIOR) against its parent's."""
    n = F.coalesce(own["n"], F.lit(0).cast("long"))
    return F.call_function("div", n * F.coalesce(own[q], F.lit(0).cast("long")) + PRIOR * parent, n + PRIOR)


def group_fences(groups: DataFrame, sketch: DataFrame) -> DataFrame:
    """(lang, source) of ``groups``, each once, with a map of (low, high) by metric; null
    bounds where no document passes the base rules at all."""
    whole = quartiles(sketch, []).collect()  # one row: three numbers a metric
    whole = whole[0]["q"] if whole else {}

    def named(by, name):
        return quartiles(sketch, by).select(*[F.col(c).alias(f"__{name}_{c}") for c in by], F.col("q").alias(f"__{name}"))

    o, g = named(["lang", "source"], "own"), named(["lang"], "lang")
    df = (groups.select("lang", "source").distinct()
          .join(o, F.col("lang").eqNullSafe(F.col("__own_lang")) & F.col("source").eqNullSafe(F.col("__own_source")), "left")
          .join(g, F.col("lang").eqNullSafe(F.col("__lang_lang")), "left"))
    entries = []
    for m, (_, _, above, below) in METRICS.items():
        q1, q3 = [blend(F.col("__own")[m], blend(F.col("__lang")[m], F.lit(whole[m][q] if m in whole else None).cast("long"), q), q)
                  for q in ("q1", "q3")]
        spread = FENCE * (q3 - q1)
        entries += [F.lit(m), F.struct((q1 - spread - F.lit(below).cast("long")).alias("low"), (q3 + spread + above).alias("high"))]
    return df.select("lang", "source", F.create_map(*entries).alias("fence"))


def quality_rules(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the counts, ``base_failed`` and ``kept``."""
    cols = [*keep, *[c for c in ("lang", "source") if c not in keep]]
    rows = features(docs, cols, text).withColumn("base_failed", base_failed())
    rows = shared(rows, "quality_counts")
    sketch = shared(sketches(rows), "quality_sketches")
    groups = group_fences(rows, sketch).withColumnsRenamed({"lang": "__l", "source": "__s"})
    out = rows.join(groups, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), "left")
    inside = F.lit(True)
    for m in METRICS:
        f = F.col("fence")[m]
        inside &= F.coalesce(bucket(ratio(m)) <= f["high"], F.lit(True))
        inside &= F.coalesce(bucket(ratio(m)) >= f["low"], F.lit(True))
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & inside).alias("kept"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])


def _duck() -> str:
    ws = r"[^\x20\x09-\x0D]+"
    sym = "length(t) - length(translate(t, '#*$%&|<>', ''))"
    metrics = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS metric, (({n} * 1000) // greatest({d}, 1))::BIGINT AS v FROM f WHERE NOT base_failed"
        for m, (n, d, _, _) in METRICS.items())

    def buck(v):
        return f"({v} - {v} % (1::BIGINT << greatest(length(bin({v})) - {BITS}, 0)::BIGINT))"

    def quart(by):
        keys = "".join(f"{b}, " for b in by)
        return f"""(SELECT {keys} metric, any_value(total) AS n, min(b) FILTER (4 * c >= total) AS q1, min(b) FILTER (4 * c >= 3 * total) AS q3
           FROM (SELECT {keys} metric, b, sum(n) OVER (PARTITION BY {keys} metric ORDER BY b) AS c,
                        sum(n) OVER (PARTITION BY {keys} metric) AS total
                 FROM (SELECT {keys} metric, b, count(*) AS n FROM v GROUP BY {keys} metric, b))
           GROUP BY {keys} metric)"""

    def mix(name, m, q, parent):
        n = f"coalesce({name}.n_{m}, 0)"
        return f"(({n} * coalesce({name}.{q}_{m}, 0) + {PRIOR} * {parent}) // ({n} + {PRIOR}))"

    def quartile(m, q):
        return mix("own", m, q, mix("lan", m, q, f"whole.{q}_{m}"))

    blended = ", ".join(f"{quartile(m, q)} AS {q}_{m}" for m in METRICS for q in ("q1", "q3"))
    fence = ", ".join(
        f"q1_{m} - {FENCE} * (q3_{m} - q1_{m}) - {'NULL' if v[3] is None else v[3]} AS l_{m}, q3_{m} + {FENCE} * (q3_{m} - q1_{m}) + {v[2]} AS h_{m}"
        for m, v in METRICS.items())
    checks = " AND ".join(
        f"""coalesce({buck(f"((f.{n} * 1000) // greatest(f.{d}, 1))::BIGINT")} BETWEEN coalesce(l_{m}, -1) AND h_{m}, true)"""
        for m, (n, d, _, _) in METRICS.items())
    picks = ", ".join(f"max({x}) FILTER (metric = '{m}') AS {x}_{m}" for m in METRICS for x in ("n", "q1", "q3"))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT rid, regexp_extract_all(t, '{ws}') AS w FROM d),
    g AS (SELECT rid, unnest(range(len(w) - 4)) AS i, unnest(list_transform(range(len(w) - 4), lambda i: w[i + 1:i + 5])) AS g
          FROM w WHERE len(w) >= 5),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
    r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
    l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}')) AS l FROM d),
    f AS (SELECT d.rid, doc_id, lang, source, len(w.w)::BIGINT AS n_words,
            coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
            ({sym})::BIGINT AS n_symbols, len(l.l)::BIGINT AS n_lines,
            (len(l.l) - len(list_distinct(l.l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
            len(w.w) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(w.w) AS base_failed
          FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid)),
    v AS (SELECT lang, source, metric, {buck("v")} AS b FROM ({metrics})),
    own AS (SELECT lang, source, {picks} FROM {quart(["lang", "source"])} GROUP BY lang, source),
    lan AS (SELECT lang, {picks} FROM {quart(["lang"])} GROUP BY lang),
    whole AS (SELECT {picks} FROM {quart([])}),
    q AS (SELECT f.rid, {blended}
          FROM f LEFT JOIN own ON f.lang IS NOT DISTINCT FROM own.lang AND f.source IS NOT DISTINCT FROM own.source
          LEFT JOIN lan ON f.lang IS NOT DISTINCT FROM lan.lang LEFT JOIN whole ON true),
    k AS (SELECT rid, {fence} FROM q)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {checks} AS kept
    FROM f JOIN k USING (rid)"""


QUERIES = {"op9_quality": op9_quality}
ORACLE = {"op9_quality": _duck()}
