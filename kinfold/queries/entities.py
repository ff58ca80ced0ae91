"""Queries over response and entity JSON and over the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.functions import docs
from kinfold.operators import documents as ed, upsert
from kinfold.operators.outcomes import outcome_union
from kinfold.plans import mart as marts
from kinfold.queries import fixtures as fx
from kinfold.queries.registry import Tables, query
from kinfold.schemas import MART, MART_TABLES
from kinfold.session import materialize, scratch, spread
from kinfold.streaming.marts import start_mart_sync

# --- responses and scalars -------------------------------------------------------------------


@query("json_affected_ids", """
SELECT event_id, user_id AS entity_id FROM events WHERE event_type <> 'view'
UNION ALL SELECT event_id, user_id + 1000 FROM events WHERE event_type <> 'view'""")
def json_affected_ids(t: Tables) -> DataFrame:
    """Responses with two integer ids and three that are not; views have no list at all."""
    user = F.col("user_id").cast("string")
    listed = F.concat(
        F.lit('{"DATA_SOURCE":"E","AFFECTED_ENTITIES":[{"ENTITY_ID":'), user, F.lit('},{"ENTITY_ID":"'), user,
        F.lit('"},{"ENTITY_ID":1.5},{"OTHER":1},{"ENTITY_ID":'), (F.col("user_id") + 1000).cast("string"), F.lit("}]}"),
    )
    response = F.when(F.col("event_type") == "view", F.lit('{"DATA_SOURCE":"E"}')).otherwise(listed)
    rows = t.events.select("event_id", response.alias("r"))
    return rows.select("event_id", F.explode(docs.affected_ids(F.col("r"))).alias("entity_id"))


@query("json_search_ids", """
SELECT event_id, user_id AS entity_id FROM events WHERE event_type <> 'click'""")
def json_search_ids(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    found = F.concat(
        F.lit('{"RESOLVED_ENTITIES":[{"ENTITY":{"RESOLVED_ENTITY":{"ENTITY_ID":'), user,
        F.lit('}}},{"ENTITY":{"RESOLVED_ENTITY":{"ENTITY_ID":"x"}}},{"ENTITY":{}}]}'),
    )
    response = F.when(F.col("event_type") == "click", F.lit('{"RESOLVED_ENTITIES":[]}')).otherwise(found)
    rows = t.events.select("event_id", response.alias("r"))
    return rows.select("event_id", F.explode(docs.search_ids(F.col("r"))).alias("entity_id"))


@query("flag_decode", """
SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false WHEN 'signup' THEN true WHEN 'error' THEN false END AS text_flag,
  CASE event_type WHEN 'click' THEN user_id <> 0 WHEN 'view' THEN false WHEN 'signup' THEN true WHEN 'error' THEN false END AS json_flag
FROM events""")
def flag_decode(t: Tables) -> DataFrame:
    """The same flag as text and as JSON values of several types."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", " yes ").when(kind == "view", "N").when(kind == "signup", "True")
        .when(kind == "error", "0").otherwise("maybe")
    )
    value = (
        F.when(kind == "click", F.col("user_id").cast("string")).when(kind == "view", F.lit("false"))
        .when(kind == "signup", F.lit('"y"')).when(kind == "error", F.lit("0")).otherwise(F.lit("2.5"))
    )
    return t.events.select(
        "event_id", docs.text_flag(text).alias("text_flag"), docs.variant_flag(F.parse_json(value)).alias("json_flag")
    )


@query("ts_parse", """
SELECT event_id, CASE WHEN event_type <> 'view' THEN epoch_us(ts) - CASE WHEN event_type = 'click' THEN epoch_us(ts) % 1000000 ELSE 0 END END AS micros
FROM events""")
def ts_parse(t: Tables) -> DataFrame:
    """Stamps with and without a fraction; those of views have a shape that is no timestamp."""
    text = (
        F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format("ts", "dd.MM.yyyy HH:mm"))
        .otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    )
    return t.events.select("event_id", F.unix_micros(docs.seen_at(text)).alias("micros"))


@query("bounds_parse", """
SELECT event_id, user_id - 10 AS range_start, user_id + event_id AS range_end FROM events""")
def bounds_parse(t: Tables) -> DataFrame:
    """Small users give a negative start, so the text holds more than one dash."""
    text = F.concat_ws("-", F.col("user_id") - 10, F.col("user_id") + F.col("event_id"))
    rows = t.events.select("event_id", text.alias("bounds"))
    return rows.select("event_id", docs.range_start(F.col("bounds")).alias("range_start"), docs.range_end(F.col("bounds")).alias("range_end"))


# --- entity documents ------------------------------------------------------------------------


def _parsed(t: Tables, version: int = 1) -> DataFrame:
    return docs.parse_documents(fx.documents(t, version), page="page")


_E = f"WITH {fx.ENTITY_SQL}"
_N1 = """n1 AS (SELECT id, count(*) AS n FROM r1 GROUP BY id),
q1 AS (SELECT id, count(*) AS n FROM (SELECT lo AS id FROM p1 UNION ALL SELECT hi FROM p1) GROUP BY id)"""


@query("doc_entity", f"""{_E}, {_N1}
SELECT c1.id AS entity_id, name AS entity_name, CAST(coalesce(n1.n, 0) AS INTEGER) AS record_count, CAST(coalesce(q1.n, 0) AS INTEGER) AS relation_count
FROM c1 LEFT JOIN n1 USING (id) LEFT JOIN q1 USING (id)""")
def doc_entity(t: Tables) -> DataFrame:
    return docs.entity_frame(_parsed(t)).select("entity_id", "entity_name", "record_count", "relation_count")


@query("doc_record_summary", f"""{_E}
SELECT id AS entity_id, ds AS data_source, CAST(count(*) AS INTEGER) AS n FROM r1 GROUP BY id, ds
UNION ALL SELECT id, 'NONE', 0 FROM c1 UNION ALL SELECT id, 'TWICE', 2 FROM c1""")
def doc_record_summary(t: Tables) -> DataFrame:
    """Each summary gets an entry without a count and one source listed twice."""
    marked = F.replace(
        "json", F.lit('"RECORD_SUMMARY":['),
        F.lit('"RECORD_SUMMARY":[{"DATA_SOURCE":"NONE"},{"DATA_SOURCE":"TWICE","RECORD_COUNT":1},{"DATA_SOURCE":"TWICE","RECORD_COUNT":2},'),
    )
    closed = F.replace(marked, F.lit('"RECORD_COUNT":2},]'), F.lit('"RECORD_COUNT":2}]'))
    changed = fx.documents(t, 1).withColumn("json", closed)
    rows = docs.parse_documents(changed).select("entity_id", F.explode_outer("record_summary").alias("data_source", "n"))
    return rows.filter(F.col("data_source").isNotNull())  # see session.unfold


@query("doc_entity_record", f"""{_E}
SELECT ds AS data_source, rid AS record_id, id AS entity_id, mk AS match_key, lvl AS match_level_code, code AS errule_code,
  epoch_us(seen) AS first_seen, epoch_us(seen) AS last_seen FROM r1""")
def doc_entity_record(t: Tables) -> DataFrame:
    return docs.record_frame(_parsed(t)).select(
        "data_source", "record_id", "entity_id", "match_key", "match_level_code", "errule_code",
        F.unix_micros("first_seen_dt").alias("first_seen"), F.unix_micros("last_seen_dt").alias("last_seen"),
    )


@query("doc_relationship", f"""{_E}
SELECT lo AS entity_id_lo, hi AS entity_id_hi, lvl AS match_level_code, mk AS match_key, NULL AS rev_match_key, code AS errule_code, dis AS is_disclosed, amb AS is_ambiguous FROM p1
UNION ALL SELECT lo, hi, lvl, NULL, rmk, code, dis, amb FROM p1""")
def doc_relationship(t: Tables) -> DataFrame:
    return docs.relation_frame(_parsed(t))


@query("doc_features", f"""{_E}
SELECT id AS entity_id, 'NAME' AS ftype_code, id AS lib_feat_id, name AS feat_desc, 'PRIMARY' AS usage_type, false AS used_for_cand, true AS used_for_scoring FROM c1
UNION ALL SELECT id, 'SEGMENT', nat, seg, NULL, true, NULL FROM c1
UNION ALL SELECT id, 'ALIAS', NULL, upper(name), NULL, true, false FROM c1
UNION ALL SELECT id, 'BARE', NULL, NULL, NULL, NULL, NULL FROM c1""")
def doc_features(t: Tables) -> DataFrame:
    """Flags on the value with the same id, on the feature itself, on the first value, and nowhere."""
    def value(number, cand: str, score: str):
        return F.struct(number.alias("LIB_FEAT_ID"), F.lit(cand).alias("USED_FOR_CAND"), F.lit(score).alias("USED_FOR_SCORING"))

    number = F.col("entity_id")
    features = F.struct(
        F.array(F.struct(
            F.col("entity_name").alias("FEAT_DESC"), number.alias("LIB_FEAT_ID"), F.lit("PRIMARY").alias("USAGE_TYPE"),
            F.array(value(number + 1, "Y", "N"), value(number, "no", "Yes")).alias("FEAT_DESC_VALUES"),
        )).alias("NAME"),
        F.array(F.struct(
            F.col("seg").alias("FEAT_DESC"), F.col("nat").alias("LIB_FEAT_ID"), F.lit("1").alias("USED_FOR_CAND"),
            F.array(value(F.col("nat"), "N", "Y")).alias("FEAT_DESC_VALUES"),
        )).alias("SEGMENT"),
        F.array(F.struct(
            F.upper("entity_name").alias("FEAT_DESC"), F.array(value(number, "true", "0"), value(number, "N", "Y")).alias("FEAT_DESC_VALUES"),
        )).alias("ALIAS"),
        F.array(F.struct(F.lit(None).cast("string").alias("FEAT_DESC"), F.lit("text").alias("LIB_FEAT_ID"))).alias("BARE"),
    )
    entity = F.struct(number.alias("ENTITY_ID"), features.alias("FEATURES"))
    json = spread(fx.customers(t, 1), "entity_id").select(F.to_json(F.struct(entity.alias("RESOLVED_ENTITY"))).alias("json"))
    return docs.feature_frame(docs.parse_documents(json)).drop("page")


@query("doc_entity_hash", f"{_E}, {fx.hashes_sql(1)} SELECT id AS entity_id, hash AS entity_hash FROM h1")
def doc_entity_hash(t: Tables) -> DataFrame:
    return docs.entity_frame(_parsed(t)).select("entity_id", "entity_hash")


@query("doc_entity_doc", f"""{_E}, {fx.hashes_sql(1)}
SELECT id AS entity_id, name AS entity_name, hash AS entity_hash FROM c1 JOIN h1 USING (id)""")
def doc_entity_doc(t: Tables) -> DataFrame:
    return docs.document_frame(_parsed(t)).select(
        "entity_id", F.get_json_object("entity_json", "$.RESOLVED_ENTITY.ENTITY_NAME").alias("entity_name"), "entity_hash"
    )


# --- fetch -----------------------------------------------------------------------------------


def _fetched(t: Tables, version: int, failing: bool = True) -> DataFrame:
    return ed.fetch_entities(fx.customer_ids(t), fx.documents(t, version), fx.read_failures(t) if failing else None)


_FETCH2 = f"""{_E},
f2 AS (
  SELECT c_custkey AS id, CASE WHEN c_nationkey = 7 THEN 'ERROR' WHEN c_custkey IN (SELECT id FROM c2) THEN 'ENTITY' ELSE 'GONE' END AS kind
  FROM customer)"""


@query("entity_fetch", f"""{_FETCH2}
SELECT f2.id AS "entityId", kind, CASE WHEN kind = 'ENTITY' THEN name END AS entity_name,
  CASE WHEN kind = 'ERROR' THEN 'RETRY_EXHAUSTED' END AS category FROM f2 LEFT JOIN c2 ON f2.id = c2.id""")
def entity_fetch(t: Tables) -> DataFrame:
    return _fetched(t, 2).select(
        "entityId", "kind", F.get_json_object("json", "$.RESOLVED_ENTITY.ENTITY_NAME").alias("entity_name"), "category"
    )


@query("mart_tombstones", f"{_FETCH2} SELECT id AS entity_id FROM f2 WHERE kind = 'GONE'")
def mart_tombstones(t: Tables) -> DataFrame:
    return ed.tombstones(_fetched(t, 2))


@query("mart_quarantine", f"""{_FETCH2}
SELECT id AS entity_id, 'RETRY_EXHAUSTED' AS category, concat('cannot read ', id) AS message, 'E7' AS raw FROM f2 WHERE kind = 'ERROR'""")
def mart_quarantine(t: Tables) -> DataFrame:
    """Read back from the mart after a pass."""
    held = _mart(t)
    held.sync(_fetched(t, 2))
    return held.read("_quarantine").select("entity_id", "category", "message", "raw")


# --- mart operators --------------------------------------------------------------------------


def _stored_hashes(t: Tables) -> DataFrame:
    return docs.entity_frame(_parsed(t, 1)).select("entity_id", "page", "entity_hash")


@query("mart_change_gate", f"""{_E}, {fx.hashes_sql(1)}, {fx.hashes_sql(2)}
SELECT h2.id AS entity_id, h2.hash AS entity_hash FROM h2 LEFT JOIN h1 USING (id) WHERE h1.hash IS NULL OR h1.hash <> h2.hash""")
def mart_change_gate(t: Tables) -> DataFrame:
    return upsert.change_gate(materialize(_parsed(t, 2), "parsed"), _stored_hashes(t)).select("entity_id", "entity_hash")


def _departed(t: Tables) -> DataFrame:
    parsed = materialize(_parsed(t, 2), "parsed")
    refreshed = parsed.groupBy("entity_id").agg(F.sum("record_count").alias("n"))
    return upsert.departed_records(fx.order_records(t, 1), docs.record_frame(parsed), refreshed)


_DEPARTED = f"""{_E},
departed AS (
  SELECT ds, rid, id FROM r1 WHERE id IN (SELECT id FROM c2)
    AND NOT EXISTS (SELECT 1 FROM r2 WHERE r2.ds = r1.ds AND r2.rid = r1.rid))"""


@query("mart_departed", f"{_DEPARTED} SELECT ds AS data_source, rid AS record_id, id AS entity_id FROM departed")
def mart_departed(t: Tables) -> DataFrame:
    return _departed(t).select("data_source", "record_id", "entity_id")


@query("mart_departed_verified", f"""{_DEPARTED}
SELECT ds AS data_source, rid AS record_id FROM departed WHERE NOT EXISTS (SELECT 1 FROM o2 WHERE o2.ds = departed.ds AND o2.rid = departed.rid)""")
def mart_departed_verified(t: Tables) -> DataFrame:
    """A record that moved to a customer outside the batch still exists and is not deleted."""
    return upsert.verify_departed(_departed(t).select("data_source", "record_id"), fx.all_orders(t, 2))


@query("mart_upsert", f"""{_E}
SELECT coalesce(c1.id, c2.id) AS entity_id,
  CASE WHEN c2.id IS NOT NULL AND (c1.id IS NULL OR c1.seg <> 'BUILDING' OR c1.nat < 12) THEN c2.name ELSE c1.name END AS entity_name,
  CASE WHEN c2.id IS NOT NULL AND (c1.id IS NULL OR c1.seg <> 'BUILDING' OR c1.nat < 12) THEN 6 WHEN c1.seg = 'BUILDING' AND c1.nat >= 12 THEN 7 ELSE 5 END AS refresh_seq
FROM c1 FULL JOIN c2 ON c1.id = c2.id""")
def mart_upsert(t: Tables) -> DataFrame:
    """Pass 6 meets rows of pass 5 and, for some customers, of the later pass 7 that was written before it."""
    newer = (F.col("seg") == "BUILDING") & (F.col("nat") >= 12)
    table = _mart(t).tables["entity"]
    first, second = docs.entity_frame(_parsed(t, 1)), docs.entity_frame(_parsed(t, 2))
    held = fx.customers(t, 1).filter(newer).select("entity_id")
    table.write(7, first.join(held, "entity_id", "left_semi"))
    table.write(5, first.join(held, "entity_id", "left_anti"))
    table.write(6, second)
    return table.read(7, ["entity_name"]).select("entity_id", "entity_name", "refresh_seq")


@query("mart_relationship_upsert", f"""{_E}
SELECT coalesce(p1.lo, p2.lo) AS entity_id_lo, coalesce(p1.hi, p2.hi) AS entity_id_hi, p1.mk AS match_key, p2.rmk AS rev_match_key,
  coalesce(p2.lvl, p1.lvl) AS match_level_code, CAST(CASE WHEN p2.lo IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS refresh_seq
FROM p1 FULL JOIN p2 ON p1.lo = p2.lo AND p1.hi = p2.hi""")
def mart_relationship_upsert(t: Tables) -> DataFrame:
    """The low ends were refreshed in pass 1, the high ends are in pass 2."""
    table = _mart(t).tables["relationship"]
    table.write(1, upsert.fold_relations(docs.relation_frame(_parsed(t, 1)).filter(F.col("match_key").isNotNull())))
    table.write(2, upsert.fold_relations(docs.relation_frame(_parsed(t, 2)).filter(F.col("rev_match_key").isNotNull())))
    return table.read(2, ["match_key", "rev_match_key", "match_level_code"])


@query("mart_tombstone_cascade", f"""{_E}, gone AS (SELECT id FROM c1 WHERE id NOT IN (SELECT id FROM c2))
SELECT 'entity' AS name, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM c1 WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'entity_doc', count(*), CAST(sum(id) AS BIGINT) FROM c1 WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'entity_record', count(*), CAST(sum(id) AS BIGINT) FROM r1 WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'relationship', count(*), CAST(sum(lo) AS BIGINT) FROM p1 WHERE lo NOT IN (SELECT id FROM gone) AND hi NOT IN (SELECT id FROM gone)""")
def mart_tombstone_cascade(t: Tables) -> DataFrame:
    """Version 1, then a pass in which the entities that version 2 no longer has are gone."""
    held = _mart(t)
    held.sync(_fetched(t, 1, failing=False))
    held.sync(_fetched(t, 2, failing=False).filter("kind = 'GONE'"))
    total = None
    for name in MART_TABLES:
        key = "entity_id_lo" if name == "relationship" else "entity_id"
        columns = [key] if name == "entity_record" else []
        row = held.read(name, columns=columns).agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("ids")).select(F.lit(name).alias("name"), "n", "ids")
        total = row if total is None else total.unionByName(row)
    return total


# --- mart passes -----------------------------------------------------------------------------


def _mart(t: Tables) -> marts.EntityMart:
    held = marts.EntityMart(t.spark, scratch(t.spark, "mart"))
    held.create()
    return held


def _two_passes(t: Tables) -> marts.EntityMart:
    """Version 1 without failures, then version 2 in which some reads fail."""
    held = _mart(t)
    held.sync(_fetched(t, 1, failing=False))
    held.sync(_fetched(t, 2), live=fx.all_orders(t, 2))
    return held


# After both passes: entities whose second read failed keep version 1; the rest is version 2. A row
# carries the pass that last changed it.
_FINAL = f"""{_FETCH2}, {fx.hashes_sql(1)}, {fx.hashes_sql(2)},
changed AS (
  SELECT f2.id FROM f2 JOIN h2 ON f2.id = h2.id LEFT JOIN h1 ON f2.id = h1.id
  WHERE kind = 'ENTITY' AND (h1.hash IS NULL OR h1.hash <> h2.hash)),
gone AS (SELECT id FROM f2 WHERE kind = 'GONE'),
final_entity AS (
  SELECT c2.id, c2.name, h2.hash, 2 AS seq FROM c2 JOIN h2 USING (id) WHERE c2.id IN (SELECT id FROM changed)
  UNION ALL
  SELECT c1.id, c1.name, h1.hash, 1 FROM c1 JOIN h1 USING (id) WHERE c1.id NOT IN (SELECT id FROM changed) AND c1.id NOT IN (SELECT id FROM gone)),
fresh AS (SELECT * FROM r2 WHERE id IN (SELECT id FROM changed)),
dropped AS (
  SELECT ds, rid FROM r1 WHERE id IN (SELECT id FROM gone)
  UNION
  SELECT ds, rid FROM r1 WHERE id IN (SELECT id FROM changed)
    AND NOT EXISTS (SELECT 1 FROM o2 WHERE o2.ds = r1.ds AND o2.rid = r1.rid)),
final_record AS (
  SELECT ds, rid, id FROM fresh
  UNION ALL
  SELECT ds, rid, id FROM r1 WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh.ds = r1.ds AND fresh.rid = r1.rid)
    AND NOT EXISTS (SELECT 1 FROM dropped WHERE dropped.ds = r1.ds AND dropped.rid = r1.rid))"""


@query("mart_sync_pass", f"""{_FINAL}
SELECT id AS entity_id, name AS entity_name, hash AS entity_hash, CAST(seq AS BIGINT) AS refresh_seq FROM final_entity""")
def mart_sync_pass(t: Tables) -> DataFrame:
    return _two_passes(t).read("entity", columns=["entity_name", "entity_hash"]).drop("page")


@query("mart_orphan_reconcile", f"{_FINAL} SELECT ds AS data_source, rid AS record_id, id AS entity_id FROM final_record")
def mart_orphan_reconcile(t: Tables) -> DataFrame:
    return _two_passes(t).read("entity_record", columns=["entity_id"]).drop("refresh_seq")


@query("mart_change_feed", f"""{_FINAL}
SELECT coalesce(a.ds, b.ds) AS data_source, coalesce(a.rid, b.rid) AS record_id,
  CASE WHEN a.id IS NULL THEN 'insert' WHEN b.id IS NULL THEN 'delete' ELSE 'update' END AS change, a.id AS old_id, b.id AS new_id
FROM r1 a FULL JOIN final_record b ON a.ds = b.ds AND a.rid = b.rid WHERE a.id IS DISTINCT FROM b.id""")
def mart_change_feed(t: Tables) -> DataFrame:
    feed = _two_passes(t).changes("entity_record", 1, 2)
    kind = F.regexp_replace("_change_type", "_.*", "")
    old = F.max(F.when(F.col("_change_type").isin("delete", "update_preimage"), F.col("entity_id")))
    new = F.max(F.when(F.col("_change_type").isin("insert", "update_postimage"), F.col("entity_id")))
    return feed.groupBy("data_source", "record_id").agg(
        F.first(kind).alias("change"), old.alias("old_id"), new.alias("new_id")
    )


@query("mart_sync_state", "SELECT 'refresh_seq' AS key, '2' AS value, (SELECT count(*) FROM customer WHERE c_nationkey = 7) AS quarantined")
def mart_sync_state(t: Tables) -> DataFrame:
    held = _two_passes(t)
    errors = held.read("_quarantine").agg(F.count(F.lit(1)).alias("quarantined"))
    return held.read("_sync_state").select("key", "value", errors.scalar().alias("quarantined"))


@query("mart_schema", f"""{_E}
SELECT 'entity' AS name, 'entity_id,page' AS keys, 6 AS n_values, (SELECT count(*) FROM c1) AS n
UNION ALL SELECT 'entity_doc', 'entity_id,page', 2, (SELECT count(*) FROM c1)
UNION ALL SELECT 'entity_record', 'data_source,record_id', 6, (SELECT count(*) FROM r1)
UNION ALL SELECT 'relationship', 'entity_id_lo,entity_id_hi', 6, (SELECT count(*) FROM p1)""")
def mart_schema(t: Tables) -> DataFrame:
    """Keys, value columns and row counts of the four tables after the first load."""
    held = _mart(t)
    held.sync(_fetched(t, 1, failing=False))
    total = None
    for name in MART_TABLES:
        row, keys = MART[name]
        counted = held.read(name, columns=[]).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("name"), F.lit(",".join(keys)).alias("keys"), F.lit(len(row) - len(keys)).alias("n_values"), "n"
        )
        total = counted if total is None else total.unionByName(counted)
    return total


@query("mart_sync_stream", f"""{_E}, {fx.hashes_sql(2)}
SELECT id AS entity_id, hash AS entity_hash FROM h2""")
def mart_sync_stream(t: Tables) -> DataFrame:
    """The affected feed names every customer twice; the stream applies it in passes."""
    path = scratch(t.spark, "mart-stream")
    touched = t.customer.select(
        F.lit("C").alias("dataSource"), F.col("c_custkey").cast("string").alias("recordId"), F.col("c_custkey").alias("entityId"),
        F.lit("ADD").alias("op"), F.explode(F.array(F.lit("r1"), F.lit("r2"))).alias("runId"),
    )
    outcome_union(affected=touched).write.parquet(f"{path}/feed")
    held = _mart(t)
    documents = fx.documents(t, 2)
    stream = start_mart_sync(t.spark, f"{path}/feed", held, lambda ids: ed.fetch_entities(ids, documents), f"{path}/cp")
    stream.awaitTermination()
    return held.read("entity", columns=["entity_hash"]).select("entity_id", "entity_hash")


@query("report_match_key", f"{_E} SELECT mk AS match_key, count(*) AS records FROM r1 GROUP BY mk")
def report_match_key(t: Tables) -> DataFrame:
    held = _mart(t)
    held.sync(_fetched(t, 1, failing=False))
    return marts.match_keys(held.read("entity_record", columns=["match_key"]))
