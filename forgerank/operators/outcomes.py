"""Enrichment outcomes: response classification (O1/S7), attempt resolution (O2),
permanent-failure rule (O3), writes (K11/K12) and the run summary (A16).

Responses are landed rows ``(username, seq, status, body, error_text)``;
``status`` null means the call raised (``error_text`` holds the message).
Classification is one column expression over the parsed body (VARIANT):
only real JSON booleans count as a flag, ``messages`` may be a string
(substring test) or an array (element test).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import retryable_error, retryable_status


def _vtype(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _flag(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "boolean")


def classify(df: DataFrame, mode: str = "regional") -> DataFrame:
    """Adds ``success, open_to_work, retryable, error_code`` (and ``error``)."""
    status, body, err = F.col("status"), F.col("body"), F.col("error_text")
    cols = df.columns
    # The parsed body and what is read from it are columns of their own, so that each is
    # evaluated once and the conditions stay small enough for code generation.
    v = F.col("__v")
    df = df.withColumn("__v", F.try_parse_json(body))
    df = df.withColumns({
        "__top": F.schema_of_variant(v), "__len": F.json_array_length(body),
        "__null": F.coalesce(F.is_variant_null(F.try_variant_get(v, "$[0]", "variant")), F.lit(False)),
        "__msg": _vtype(v, "$[0].messages"), "__data": _vtype(v, "$[0].data.open_to_work") == "BOOLEAN",
        "__flat": _vtype(v, "$[0].open_to_work") == "BOOLEAN", "__obj": _vtype(v, "$.data.open_to_work") == "BOOLEAN"})
    msg_t, is_null = F.col("__msg"), F.col("__null")
    text, items = F.try_variant_get(v, "$[0].messages", "string"), F.try_variant_get(v, "$[0].messages", "array<string>")
    timed = (F.when(msg_t == "STRING", (text != "") & text.contains(D.TIMEOUT_MESSAGE))
             .when(msg_t.startswith("ARRAY"), F.array_contains(items, D.TIMEOUT_MESSAGE)))
    # Any other value of ``messages`` that counts as true has no substring test: it raises.
    odd = (F.when(msg_t == "BOOLEAN", F.try_variant_get(v, "$[0].messages", "boolean"))
           .when(msg_t.startswith("OBJECT"), F.lit(True))
           .when(~msg_t.isin("STRING", "VOID") & ~msg_t.startswith("ARRAY"),
                 F.try_variant_get(v, "$[0].messages", "double") != 0))
    is_arr = F.col("__top").startswith("ARRAY")
    df = df.withColumns({
        "__nonempty": F.coalesce(is_arr & (F.col("__len") > 0), F.lit(False)),
        "__timed": F.coalesce(timed, F.lit(False)), "__odd": F.coalesce(odd, F.lit(False)),
        "__bad": v.isNull() | F.is_variant_null(v), "__o": F.coalesce(~is_arr & F.col("__obj"), F.lit(False))})
    nonempty, timed_out, odd_messages, bad_json = (F.col(c) for c in ("__nonempty", "__timed", "__odd", "__bad"))
    a_data, a_flat, o_data = F.coalesce("__data", F.lit(False)), F.coalesce("__flat", F.lit(False)), F.col("__o")
    thrown = is_null | odd_messages
    http_fail = status.isNotNull() & ~status.between(200, 299)
    raised = status.isNull()

    # Error text as the reference builds it (the global mode classifies on it).
    error = (F.when(http_fail, F.concat(F.lit("HTTP "), status.cast("string"), F.lit(": "),
                                        F.coalesce(body, F.lit(""))))
              .when(raised, F.coalesce(err, F.lit("")))
              .when(bad_json, F.lit("Unexpected token in JSON"))
              .when(nonempty & is_null, F.lit("Cannot read properties of null"))
              .when(nonempty & odd_messages, F.lit("messages.includes is not a function"))
              .when(nonempty & timed_out, F.lit("API timeout"))
              .when(nonempty & (a_data | a_flat), F.lit(None).cast("string"))
              .when(o_data, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("Unexpected response format: "), body)))
    flag = (F.when(http_fail | raised | bad_json, F.lit(None).cast("boolean"))
             .when(nonempty & thrown, F.lit(None).cast("boolean"))
             .when(nonempty & timed_out, F.lit(None).cast("boolean"))
             .when(nonempty & a_data, _flag(v, "$[0].data.open_to_work"))
             .when(nonempty & a_flat, _flag(v, "$[0].open_to_work"))
             .when(o_data, _flag(v, "$.data.open_to_work")))
    success = F.col("__success")
    if mode == "global":
        retry = (~success) & retryable_error(F.col("__error"), D.RETRYABLE_ERRORS_GLOBAL)
        code = F.when(success, F.lit(None).cast("string")).otherwise(F.lit("FAILED"))
    else:
        exc_retry = retryable_error(F.col("__error"), D.RETRYABLE_ERRORS_REGIONAL)
        code = (F.when(http_fail, F.concat(F.lit(D.CODE_HTTP_PREFIX), status.cast("string")))
                 .when(raised | bad_json | (nonempty & thrown),
                       F.when(exc_retry, D.CODE_TRANSIENT).otherwise(D.CODE_UNKNOWN))
                 .when(nonempty & timed_out, F.lit(D.CODE_TIMEOUT))
                 .when(success, F.lit(None).cast("string"))
                 .otherwise(F.lit(D.CODE_INVALID)))
        retry = (F.when(http_fail, retryable_status(status))
                  .when(raised | bad_json | (nonempty & thrown), exc_retry)
                  .when(nonempty & timed_out, F.lit(True))
                  .otherwise(F.lit(False)))
    df = df.withColumns({"__flag": flag, "__error": error, "__success": flag.isNotNull()})
    return df.select(*cols, success.alias("success"), F.col("__flag").alias("open_to_work"),
                     F.coalesce(retry, F.lit(False)).alias("retryable"), code.alias("error_code"),
                     F.col("__error").alias("error"))


def resolve_attempts(classified: DataFrame, max_retries: int = D.MAX_RETRIES,
                     key: str = "username", order: str = "seq") -> DataFrame:
    """O2: a user's attempts are numbered from 0 in landing ``order`` and those beyond
    ``max_retries`` were never made; the first success or first non-retryable attempt
    ends the loop, else the last attempt counts. The numbering keeps ``max_retries + 1``
    rows a user, which Spark prunes before the shuffle (WindowGroupLimit)."""
    w = W.partitionBy(key).orderBy(order)
    c = (classified.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= max_retries + 1)
         .withColumn("attempt", F.col("__n") - 1).drop("__n"))
    terminal = F.col("success") | ~F.col("retryable")
    rank_key = F.struct((~terminal).alias("open"),
                        F.when(terminal, F.col("attempt")).otherwise(-F.col("attempt")).alias("at"))
    fields = [x for x in c.columns if x != key]
    out = c.groupBy(key).agg(F.min_by(F.struct(*fields), rank_key).alias("r"),
                             F.count(F.lit(1)).alias("attempts_landed"))
    return out.select(key, "r.*", "attempts_landed").withColumn(
        "permanent", ~F.col("success") & ~F.col("retryable"))


# K11 ---------------------------------------------------------------------------------
STATE_COLS = ["is_open_to_work", "otw_scraped_at", "otw_permanent_failure", "otw_error_code"]


def apply_outcomes(board: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Regional write: success sets the flag and clears the failure; a permanent
    failure nulls the flag and records the code; a transient failure leaves the row
    untouched, as does having no outcome."""
    o = outcomes.select("username", F.col("success").alias("__s"), F.col("open_to_work").alias("__f"),
                        F.col("permanent").alias("__p"), F.col("error_code").alias("__e"))
    j = board.join(o, "username", "left")
    touched = F.coalesce(F.col("__s") | F.col("__p"), F.lit(False))
    upd = {
        "is_open_to_work": F.when(F.col("__s"), F.col("__f")).otherwise(F.lit(None).cast("boolean")),
        "otw_scraped_at": as_of,
        "otw_permanent_failure": F.coalesce(F.col("__p"), F.lit(False)),
        "otw_error_code": F.when(F.col("__s"), F.lit(None).cast("string"))
                           .otherwise(F.coalesce(F.col("__e"), F.lit(D.CODE_UNKNOWN))),
    }
    cols = [F.when(touched, upd[c]).otherwise(F.col(c)).alias(c) if c in upd else F.col(c)
            for c in board.columns]
    return j.select(*cols)


# K12 ---------------------------------------------------------------------------------
def apply_outcomes_overwrite(board: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Global write: every result writes the flag (null on failure) and the time."""
    o = outcomes.select("username", F.col("open_to_work").alias("__f"), F.lit(True).alias("__hit"))
    j = board.join(o, "username", "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    cols = []
    for c in board.columns:
        if c == "is_open_to_work":
            cols.append(F.when(hit, F.col("__f")).otherwise(F.col(c)).alias(c))
        elif c == "otw_scraped_at":
            cols.append(F.when(hit, as_of).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


# A16 ---------------------------------------------------------------------------------
def outcome_summary(outcomes: DataFrame) -> DataFrame:
    s, p = F.col("success"), F.col("permanent")
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s).alias("success"),
        F.count_if(~s & p).alias("permanent_failures"),
        F.count_if(~s & ~p).alias("transient_failures"),
        F.count_if(~s).alias("failed"),
        F.count_if(s & (F.col("open_to_work") == True)).alias("open_to_work"))  # noqa: E712
