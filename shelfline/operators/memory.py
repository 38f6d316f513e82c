"""Keyed long-term memory on an append-only log.

``put`` and ``delete`` are log rows; the current state of a key is its
latest row by (ts, seq).  Latest-wins is ``max(struct(ts, seq, ...))``:
Spark runs it as a sort aggregate (a struct of texts is no hash-aggregate
buffer), with a partial aggregation map-side, so a key with a third of all
rows still reduces to one row per task before the shuffle (a window sort would
put the whole key in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators.ids import sequential_ids

NAMESPACE_PREFIX = "user_memories"


def parsed(log: DataFrame) -> DataFrame:
    """The log with ``value``, the JSON text parsed once into a VARIANT (null where it is no
    JSON), and ``object``, whether its top level is an object.  A log stored like this is
    read without parsing again."""
    if "object" in log.columns:
        return log
    with_value = log.withColumn("value", F.try_parse_json("value_json"))
    return with_value.withColumn("object", F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False)))


def accepted(log: DataFrame) -> DataFrame:
    """Writes the store accepts: deletes, and puts whose value is a JSON
    object (a rejected put leaves the stored value unchanged)."""
    return parsed(log).filter((F.col("op") == "delete") | F.col("object"))


def latest_state(log: DataFrame, keys=("user_id", "key")) -> DataFrame:
    """Last accepted row per key (ts, then seq breaks ties), tombstones
    kept."""
    last = F.max(F.struct("ts", "seq", "op", "value_json")).alias("last")
    return (accepted(log).groupBy(*keys).agg(last)
            .select(*keys, F.col("last.op").alias("last_op"),
                    F.col("last.value_json").alias("value_json"),
                    F.col("last.ts").alias("ts"), F.col("last.seq").alias("seq")))


def live_memories(log: DataFrame) -> DataFrame:
    """Keys whose latest row is a put (deleted keys are gone)."""
    return (latest_state(log).filter(F.col("last_op") == "put")
            .select("user_id", "key", "value_json", "ts"))


def memory_fields(log: DataFrame) -> DataFrame:
    """The keys inside the live memories' objects, one row each: ``(user_id, key, field,
    text)``; a string as its text, anything else as JSON.  Values are VARIANT all the way
    (``variant_explode``): the newest row of a key is found on (ts, seq), then its fields
    are taken out."""
    rows = accepted(log)
    last = rows.groupBy("user_id", "key").agg(F.max(F.struct("ts", "seq")).alias("last"))
    live = (rows.join(last, ["user_id", "key"]).where("op = 'put' and ts = last.ts and seq = last.seq")
            .select("user_id", "key", "value"))
    fields = live.lateralJoin(live.sparkSession.tvf.variant_explode(F.col("value").outer()))
    one = F.col("_field")
    text = F.when(F.schema_of_variant(one) == "STRING", F.variant_get(one, "$", "string")).otherwise(F.to_json(one))
    return fields.toDF("user_id", "key", "value", "pos", "field", "_field").select("user_id", "key", "field", text.alias("text"))


def json_validate(log: DataFrame) -> DataFrame:
    """A stored value must be a JSON object; others are rejected with
    a reason."""
    reason = (F.when(F.col("value_json").isNull(), F.lit("missing value"))
              .when(F.col("value").isNull(), F.lit("invalid JSON"))
              .when(~F.col("object"), F.lit("not a JSON object")))
    return (parsed(log).filter(F.col("op") == "put")
            .select("seq", "user_id", "key", reason.isNull().alias("is_valid"),
                    reason.alias("reason")))


def to_text(log: DataFrame) -> DataFrame:
    """Value as text — a JSON string is unquoted, anything else keeps
    its JSON text."""
    as_str = F.when(F.schema_of_variant("value") == "STRING", F.variant_get("value", "$", "string"))
    return parsed(log).select("seq", F.coalesce(as_str, F.col("value_json")).alias("text"))


def resolve_ids(log: DataFrame) -> DataFrame:
    """C20: the first id that is known (user, e-mail, session, then a default),
    and the memory namespace with '.' replaced by '-'."""
    uid = F.coalesce("user_id", "email", "session_id", F.lit("default_user"))
    return log.select("seq", uid.alias("user_id"),
                      F.concat_ws("/", F.lit(NAMESPACE_PREFIX), F.translate(uid, ".", "-"))
                      .alias("namespace"))


def memory_search(log: DataFrame, user_id, query: str, k: int = 5) -> DataFrame:
    """H4: recall inside one namespace — live memories ranked by how many
    query terms occur in key + value, newest first on ties; top k."""
    live = live_memories(log).filter(F.col("user_id") == user_id)
    doc = C.terms(F.concat_ws(" ", "key", "value_json"))
    shared = F.array_intersect(doc, C.terms(F.lit(query)))   # one tokeniser for both
    score = F.size(F.array_remove(shared, ""))
    return (live.select("user_id", "key", "value_json", "ts", score.alias("score"))
            .orderBy(F.desc("score"), F.desc("ts"), "key").limit(k))


def action_items_defaults(items: DataFrame) -> DataFrame:
    """A10/G1: defaults on insert (status 'open', created now) and dense ids
    from 1 in (created_ts, source id) order."""
    filled = items.select(
        F.col("id").alias("source_id"), "session_id", "title",
        F.coalesce("status", F.lit("open")).alias("status"),
        F.coalesce("created_ts", F.localtimestamp()).alias("created_ts"))
    return sequential_ids(filled, ["created_ts", "source_id"], "item_id")


def action_items_open(items: DataFrame) -> DataFrame:
    """H6: open items per session (an item without a status is open, as A10 fills it)."""
    return (items.filter(F.coalesce("status", F.lit("open")) == "open").groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("n_open")))


def chat_history(chat: DataFrame, session_id) -> DataFrame:
    """H5: one session's messages in turn order."""
    return chat.filter(F.col("session_id") == session_id).orderBy("turn")


SEED_ROLE, SEED_TEXT = "system", "You are a helpful sales analytics assistant."


def seed_if_absent(chat: DataFrame) -> DataFrame:
    """A9 + E7: rows to insert — a system message for every session that has
    none yet (INSERT ... WHERE NOT EXISTS as a left anti join).  Running it
    again after the insert yields no rows."""
    sessions = chat.select("session_id").distinct()
    has = chat.filter(F.col("role") == SEED_ROLE).select("session_id")
    return (sessions.join(has, "session_id", "left_anti")
            .select("session_id", F.lit(-1).cast("long").alias("turn"),
                    F.lit(SEED_ROLE).alias("role"), F.lit(SEED_TEXT).alias("content")))
