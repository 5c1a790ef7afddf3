"""Secret scans with an incremental blob ledger, on DataFrame functions only.

Every version of every path is content-addressed (sha-256 of its text). The ledger
keeps which (blob, rule version) pairs have been scanned and what was found; a run
scans only the pairs not in it, and joins the findings back to all paths that hold
the blob. So copies are scanned once, and unchanged texts never again.

A necessary condition of the rules (``MAYBE``, one regular expression) is tested
where a text is read; only texts that pass it are moved, all others travel as their
digest. Positions come from splitting a text at a rule's matches: piece and match
lengths, summed in order, give code point offsets.

Defined results: a null text is the empty text, without findings; repeated rows and
null ids are paths like any other and keep their rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shared
from .common import table


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# FIXED VALUES: the rules, in the order in which findings at one place are listed:
# name, pattern, the group whose length counts, its least length.
KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = [
    ("assign", rf"({KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),  # least lengths inside the pattern where what
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # is too short cannot hide a longer match
]
MAYBE = rf"(?:{KEYWORDS})[\"']?\x20*[:=]|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}"
VERSION = "2026-1"


def versions_of(paths: DataFrame, path_cols: list[str], text: str = "text") -> DataFrame:
    """(path columns, blob, body): body is the text where a rule may match it, else null."""
    t = F.coalesce(F.col(text), F.lit(""))
    return paths.select(*path_cols, F.unhex(F.sha2(t.cast("binary"), 256)).alias("blob"),
                        F.when(t.rlike(MAYBE), t).alias("body"))


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, kind, start, end) of all matches in ``body`` that the rules keep; kind is
    the rule's place in the list. One exploded row a match."""
    def matches(no: int, pattern: str, group: int, least: int):
        whole = F.regexp_extract_all("body", F.lit(pattern), F.lit(0))
        part = F.regexp_extract_all("body", F.lit(pattern), F.lit(group))
        gaps = F.split("body", pattern, -1)  # one more than there are matches
        return F.transform(
            F.arrays_zip(whole.alias("m"), part.alias("g"), gaps.alias("p")),
            lambda x, i: F.struct(F.lit(no).alias("kind"), i.alias("i"), F.length(x["p"]).alias("gap"),
                                  F.length(x["m"]).alias("len"), (F.length(x["g"]) >= least).alias("ok")))

    found = [matches(no, pattern, group, least) for no, (_, pattern, group, least) in enumerate(rules)]
    rows = blobs.select("blob", F.inline(F.concat(*found))).where(F.col("len").isNotNull())
    order = Window.partitionBy("blob", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(order)
    return (rows.withColumn("end", end).where("ok")
            .select("blob", "kind", (F.col("end") - F.col("len")).alias("start"), "end"))


class Ledger:
    """Blobs scanned and findings, as Parquet tables in a shared folder. A run appends;
    its findings are written before its blobs, so a run that was cut off is scanned
    again, and findings are read as distinct rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    SCANNED = "blob binary, rules string"
    FINDINGS = "blob binary, rules string, kind int, start long, end long"

    def _read(self, name: str, schema: str) -> DataFrame:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there \
            else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", self.SCANNED)

    def findings(self) -> DataFrame:
        return self._read("findings", self.FINDINGS).distinct()

    def update(self, versions: DataFrame, rules=RULES, version: str = VERSION) -> None:
        """Scans the blobs of ``versions`` that this rule version has not seen. Stored
        copies of the blobs are told apart by digest alone, so of a group of copies
        one body is kept before the scan."""
        seen = self.scanned().where(F.col("rules") == version)
        fresh = (versions.groupBy("blob").agg(F.max("body").alias("body"))
                 .join(seen.select("blob"), "blob", "left_anti"))
        fresh = shared(fresh, "fresh_blobs")
        (scan(fresh.where("body is not null"), rules).withColumn("rules", F.lit(version))
         .select("blob", "rules", "kind", F.col("start").cast("long"), F.col("end").cast("long"))
         .write.mode("append").parquet(f"{self.path}/findings"))
        (fresh.select("blob", F.lit(version).alias("rules"))
         .write.mode("append").parquet(f"{self.path}/scanned"))


def by_blob(findings: DataFrame, rules=RULES) -> DataFrame:
    """One row a blob with findings: its spans in order, (start, kind, end)."""
    return findings.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))


def scan_paths(paths: DataFrame, path_cols: list[str], ledger: Ledger, text: str = "text",
               version: str = VERSION) -> DataFrame:
    """Runs the ledger over ``paths`` and gives every row of it (path columns, ``blob``)
    with its ``found`` spans (null: none)."""
    versions = shared(versions_of(paths, path_cols, text), "versions")
    ledger.update(versions, version=version)
    found = by_blob(ledger.findings().where(F.col("rules") == version))
    return versions.drop("body").join(found, "blob", "left")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scan_paths(docs, ["doc_id"], Ledger(spark, scratch_path(spark, "secret_ledger")))
    names = F.array(*[F.lit(r[0]) for r in RULES])
    spans = F.concat_ws(",", F.transform("found", lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))

    def count(k):
        return F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == k)), F.lit(0)).cast("long")

    return rows.select("doc_id", F.when(F.col("found").isNull(), F.lit("")).otherwise(spans).alias("spans"),
                       *[F.when(F.col("found").isNull(), F.lit(0)).otherwise(count(k)).cast("long").alias(n)
                         for k, n in enumerate(("n_assign", "n_access", "n_hex"))]) \
        .select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, spark: SparkSession, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask`` (overlapping spans as
    one) and ``n_chars`` counted anew in the rows that changed."""
    ledger = Ledger(spark, scratch_path(spark, "secret_ledger"))
    ledger.update(versions_of(docs, []))
    # A span begins a new run unless it starts inside one before it. What stays is the text
    # between the runs and after the last one.
    before = Window.partitionBy("blob").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = (ledger.findings().where(F.col("rules") == VERSION)
             .withColumn("before", F.coalesce(F.max("end").over(before), F.lit(0))))
    runs = spans.groupBy(F.col("blob").alias("__blob")).agg(
        F.sort_array(F.collect_list(F.when(F.col("start") >= F.col("before"), F.struct("start", "before")))).alias("__runs"),
        F.max("end").alias("__tail"))
    cols = docs.columns
    blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    # Only rows that a rule may match meet the findings; the other texts stay where they lie.
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))

    def piece(start, end):
        return F.substring(F.col("text"), (start + 1).cast("int"), (end - start).cast("int"))

    kept = F.concat(F.transform("__runs", lambda x: piece(x["before"], x["start"])),
                    F.array(piece(F.col("__tail"), F.length("text"))))
    out = (docs.where(maybe).withColumn("__blob", blob).join(runs, "__blob", "left")
           .withColumn("__masked", F.when(F.col("__runs").isNotNull(), F.array_join(kept, mask))))
    new = {"text": F.coalesce("__masked", "text"),
           "n_chars": F.when(F.col("__masked").isNotNull(), F.length("__masked").cast("long")).otherwise(F.col("n_chars"))
           if "n_chars" in cols else None}
    changed = out.select([new[c].alias(c) if new.get(c) is not None else F.col(f"`{c}`") for c in cols])
    return changed.union(docs.where(~maybe))


def _duck() -> str:
    parts = []
    plain = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    for no, (name, pattern, group, least) in enumerate(RULES):
        pattern = plain.get(name, pattern)
        p = "'" + pattern.replace("'", "''").replace('\\"', '"') + "'"
        parts.append(f"""SELECT rid, {no} AS kind, unnest(range(len(regexp_extract_all(t, {p}, 0)) + 1)) AS i,
            unnest(regexp_extract_all(t, {p}, 0)) AS m, unnest(regexp_extract_all(t, {p}, {group})) AS g,
            unnest(string_split_regex(t, {p})) AS gap, {least} AS least FROM d""")
    names = "['assign', 'access', 'hex']"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    x AS ({" UNION ALL ".join(parts)}),
    y AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e
          FROM x WHERE m IS NOT NULL),
    z AS (SELECT rid, kind, e - length(m) AS s, e FROM y WHERE length(g) >= least),
    a AS (SELECT rid, string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
                 count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                 count(*) FILTER (kind = 2) AS n_hex FROM z GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM d LEFT JOIN a USING (rid)"""


QUERIES = {"op7_secrets": op7_secrets}
ORACLE = {"op7_secrets": _duck()}
