"""Views of the input tables in the shapes the operators work on, and the same views as SQL.

Every view covers its whole table. Where a view needs odd rows (blank keys, removed records) they are
chosen by the data, e.g. very short texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.documents import assemble_documents
from kinfold.queries.registry import Tables

# --- records ---------------------------------------------------------------------------------


def _payload(source: Column, record: Column) -> Column:
    return F.to_json(F.struct(
        source.alias("DATA_SOURCE"), record.alias("RECORD_ID"), F.col("text").alias("TEXT"), F.col("lang").alias("LANG")
    ))


def records(t: Tables) -> DataFrame:
    """Documents as clean records."""
    key = F.col("doc_id").cast("string")
    return t.documents.select(
        F.col("doc_id").alias("record_seq"), F.col("source").alias("dataSource"), key.alias("recordId"),
        _payload(F.col("source"), key).alias("payload"),
    )


def raw_records(t: Tables) -> DataFrame:
    """Documents as records, some without their keys."""
    source = F.when(F.col("n_chars") < 60, "").otherwise(F.col("source"))
    key = F.when((F.col("n_chars") < 30) | (F.col("n_chars") > 9000), " ").otherwise(F.col("doc_id").cast("string"))
    return t.documents.select(
        F.col("doc_id").alias("record_seq"), source.alias("dataSource"), key.alias("recordId"),
        _payload(source, key).alias("payload"),
    )


RAW_SQL = """raw AS (
  SELECT doc_id, text, lang,
    CASE WHEN n_chars < 60 THEN '' ELSE source END AS ds,
    CASE WHEN n_chars < 30 OR n_chars > 9000 THEN ' ' ELSE CAST(doc_id AS VARCHAR) END AS rid
  FROM documents),
gated AS (
  SELECT *, CASE WHEN trim(ds) = '' THEN 'DATA_SOURCE' WHEN trim(rid) = '' THEN 'RECORD_ID' END AS missing FROM raw)"""

UNREGISTERED = "src19"


def registry(t: Tables) -> DataFrame:
    return t.documents.select(F.col("source").alias("data_source")).distinct().filter(F.col("data_source") != UNREGISTERED)


def md5_of_text(frame: DataFrame) -> DataFrame:
    return frame.select("dataSource", "recordId", F.md5(F.get_json_object("payload", "$.TEXT")).alias("text_md5"))


# --- logs ------------------------------------------------------------------------------------


def log(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(
        F.col("event_type").alias("DATA_SOURCE"), F.col("user_id").alias("RECORD_ID"), F.col("props").alias("PROPS")
    ))
    return t.events.select(F.col("event_id").alias("offset"), body.alias("value"))


def commits(t: Tables) -> DataFrame:
    """Ranges of 100 offsets, committed when their last event came in. A range that holds an event of
    a very high value is still in flight."""
    ranges = t.events.groupBy(F.floor(F.col("event_id") / 100).alias("g")).agg(
        F.max("value").alias("top"), F.max("ts").alias("committed_at")
    )
    return ranges.filter(F.col("top") <= IN_FLIGHT).select(
        (F.col("g") * 100).cast("bigint").alias("range_start"), (F.col("g") * 100 + 100).cast("bigint").alias("range_end"),
        "committed_at",
    )


IN_FLIGHT = 370.0
COMMITS_SQL = f"""commits AS (
  SELECT CAST(floor(event_id / 100) * 100 AS BIGINT) AS range_start,
         CAST(floor(event_id / 100) * 100 + 100 AS BIGINT) AS range_end, max(ts) AS committed_at
  FROM events GROUP BY 1, 2 HAVING max(value) <= {IN_FLIGHT})"""


# Error category of an event type (fixed values of this fixture).
CATEGORY_OF_EVENT = {
    "signup": "BAD_INPUT", "click": "CONFIG_RELEVANT", "view": "REPLACE_CONFLICT",
    "purchase": "RETRY_EXHAUSTED", "error": "NOT_FOUND",
}


def cases(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def errors(t: Tables) -> DataFrame:
    """Every event as a failed record of its user; users fail again and again, so keys repeat."""
    return t.events.select(
        F.lit("events").alias("dataSource"), F.col("user_id").cast("string").alias("recordId"),
        F.col("props").alias("payload"), F.expr(cases("event_type", CATEGORY_OF_EVENT)).alias("category"),
        F.lit("").alias("errorCode"), F.col("event_type").alias("message"),
        F.get_json_object("props", "$.k").cast("int").alias("attempts"), F.col("ts").alias("failedAt"),
        F.lit("fixture").alias("source"),
    )


ERRORS_SQL = f"""errors AS (
  SELECT 'events' AS ds, CAST(user_id AS VARCHAR) AS rid, props AS payload, {cases('event_type', CATEGORY_OF_EVENT)} AS category,
         event_type AS message, CAST(json_extract_string(props, '$.k') AS INTEGER) AS attempts, ts
  FROM events)"""

# --- entities of customers -------------------------------------------------------------------
# Entity = customer, its records = its orders (source = priority), relations = neighbours by key.
# Version 1 is the earlier state, version 2 the later one.

_LATE = "c_mktsegment = 'MACHINERY' AND c_acctbal < 0"      # only in version 2
_GONE = "c_mktsegment = 'FURNITURE' AND c_acctbal < 0"      # only in version 1
_RENAMED = "c_mktsegment = 'BUILDING' AND c_acctbal < 0"    # another name in version 2
_DROPPED = "o_orderstatus = 'F' AND o_totalprice < 50000"   # record gone in version 2
_MOVED = "o_orderstatus = 'P' AND o_totalprice < 50000"     # record of the next customer in version 2

ENTITY_SQL = f"""c1 AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS seg, c_nationkey AS nat, c_acctbal AS bal
  FROM customer WHERE NOT ({_LATE})),
c2 AS (
  SELECT c_custkey AS id, CASE WHEN {_RENAMED} THEN concat(c_name, ' Jr') ELSE c_name END AS name,
    c_mktsegment AS seg, c_nationkey AS nat, c_acctbal AS bal
  FROM customer WHERE NOT ({_GONE})),
o1 AS (
  SELECT o_orderpriority AS ds, CAST(o_orderkey AS VARCHAR) AS rid, o_custkey AS id, concat('+', o_orderstatus) AS mk,
    'RESOLVED' AS lvl, o_orderstatus AS code, o_orderdate AS seen FROM orders),
o2 AS (
  SELECT o_orderpriority AS ds, CAST(o_orderkey AS VARCHAR) AS rid,
    CASE WHEN {_MOVED} THEN o_custkey + 1 ELSE o_custkey END AS id,
    concat('+', o_orderstatus) AS mk, 'RESOLVED' AS lvl, o_orderstatus AS code, o_orderdate AS seen
  FROM orders WHERE NOT ({_DROPPED})),
r1 AS (SELECT o1.* FROM o1 JOIN c1 ON o1.id = c1.id),
r2 AS (SELECT o2.* FROM o2 JOIN c2 ON o2.id = c2.id),
p1 AS (
  SELECT a.id AS lo, b.id AS hi, CASE WHEN a.seg = b.seg THEN 'POSSIBLY_SAME' ELSE 'POSSIBLY_RELATED' END AS lvl,
    concat('+', a.seg) AS mk, concat('+', b.seg) AS rmk, 'NEXT' AS code, a.nat = b.nat AS dis, a.bal < 0 AND b.bal < 0 AS amb
  FROM c1 a JOIN c1 b ON b.id = a.id + 1),
p2 AS (
  SELECT a.id AS lo, b.id AS hi, CASE WHEN a.seg = b.seg THEN 'POSSIBLY_SAME' ELSE 'POSSIBLY_RELATED' END AS lvl,
    concat('+', a.seg) AS mk, concat('+', b.seg) AS rmk, 'NEXT' AS code, a.nat = b.nat AS dis, a.bal < 0 AND b.bal < 0 AS amb
  FROM c2 a JOIN c2 b ON b.id = a.id + 1)"""


def hashes_sql(version: int) -> str:
    """CTE h<version>(id, hash): the content hash computed from the base tables."""
    v = version
    return f"""
rt{v} AS (SELECT id, list_sort(list(concat_ws(chr(31), ds, rid, mk, lvl, code))) AS x FROM r{v} GROUP BY id),
pe{v} AS (
  SELECT lo AS id, concat_ws(chr(31), CAST(lo AS VARCHAR), CAST(hi AS VARCHAR), mk, '', lvl, code, CAST(dis AS VARCHAR), CAST(amb AS VARCHAR)) AS s FROM p{v}
  UNION ALL
  SELECT hi, concat_ws(chr(31), CAST(lo AS VARCHAR), CAST(hi AS VARCHAR), '', rmk, lvl, code, CAST(dis AS VARCHAR), CAST(amb AS VARCHAR)) FROM p{v}),
pt{v} AS (SELECT id, list_sort(list(s)) AS x FROM pe{v} GROUP BY id),
st{v} AS (SELECT id, list(concat_ws(chr(31), ds, CAST(n AS VARCHAR)) ORDER BY ds) AS x FROM (SELECT id, ds, count(*) AS n FROM r{v} GROUP BY id, ds) GROUP BY id),
h{v} AS (
  SELECT c{v}.id, sha256(array_to_string(list_concat(list_concat(list_concat(list_concat(
      [concat_ws(chr(31), 'ID', CAST(c{v}.id AS VARCHAR)), concat_ws(chr(31), 'NAME', c{v}.name)],
      coalesce(rt{v}.x, [])), coalesce(pt{v}.x, [])),
      list_sort([concat_ws(chr(31), 'NAME', CAST(c{v}.id AS VARCHAR), c{v}.name, 'PRIMARY', 'true', 'true'),
                 concat_ws(chr(31), 'SEGMENT', CAST(c{v}.nat AS VARCHAR), c{v}.seg, '', 'false', 'true')])),
      coalesce(st{v}.x, [])), chr(30))) AS hash
  FROM c{v} LEFT JOIN rt{v} USING (id) LEFT JOIN pt{v} USING (id) LEFT JOIN st{v} USING (id))"""


def customers(t: Tables, version: int) -> DataFrame:
    name = F.col("c_name") if version == 1 else F.when(F.expr(_RENAMED), F.concat("c_name", F.lit(" Jr"))).otherwise(F.col("c_name"))
    kept = t.customer.filter(~F.expr(_LATE if version == 1 else _GONE))
    return kept.select(
        F.col("c_custkey").alias("entity_id"), name.alias("entity_name"), F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").alias("nat"), F.col("c_acctbal").alias("bal"),
    )


def all_orders(t: Tables, version: int) -> DataFrame:
    """Orders as records, also those whose customer is not an entity of this version."""
    rows = t.orders
    owner = F.col("o_custkey")
    if version == 2:
        rows = rows.filter(~F.expr(_DROPPED))
        owner = F.when(F.expr(_MOVED), owner + 1).otherwise(owner)
    return rows.select(
        F.col("o_orderpriority").alias("data_source"), F.col("o_orderkey").cast("string").alias("record_id"),
        owner.alias("entity_id"), F.concat(F.lit("+"), "o_orderstatus").alias("match_key"),
        F.lit("RESOLVED").alias("match_level_code"), F.col("o_orderstatus").alias("errule_code"),
        F.col("o_orderdate").alias("first_seen_dt"), F.col("o_orderdate").alias("last_seen_dt"),
    )


def order_records(t: Tables, version: int) -> DataFrame:
    return all_orders(t, version).join(customers(t, version).select("entity_id"), "entity_id", "left_semi")


def neighbours(t: Tables, version: int) -> DataFrame:
    low = customers(t, version).alias("a")
    high = customers(t, version).alias("b")
    joined = low.join(high, F.col("b.entity_id") == F.col("a.entity_id") + 1)
    return joined.select(
        F.col("a.entity_id").alias("entity_id_lo"), F.col("b.entity_id").alias("entity_id_hi"),
        F.when(F.col("a.seg") == F.col("b.seg"), "POSSIBLY_SAME").otherwise("POSSIBLY_RELATED").alias("match_level_code"),
        F.concat(F.lit("+"), "a.seg").alias("match_key"), F.concat(F.lit("+"), "b.seg").alias("rev_match_key"),
        F.lit("NEXT").alias("errule_code"), (F.col("a.nat") == F.col("b.nat")).alias("is_disclosed"),
        ((F.col("a.bal") < 0) & (F.col("b.bal") < 0)).alias("is_ambiguous"),
    )


def customer_features(t: Tables, version: int) -> DataFrame:
    rows = F.array(
        F.struct(
            F.lit("NAME").alias("ftype"), F.col("entity_name").alias("feat_desc"), F.col("entity_id").alias("lib_feat_id"),
            F.lit("PRIMARY").alias("usage_type"), F.lit(True).alias("used_for_cand"), F.lit(True).alias("used_for_scoring"),
        ),
        F.struct(
            F.lit("SEGMENT").alias("ftype"), F.col("seg").alias("feat_desc"), F.col("nat").cast("bigint").alias("lib_feat_id"),
            F.lit("").alias("usage_type"), F.lit(False).alias("used_for_cand"), F.lit(True).alias("used_for_scoring"),
        ),
    )
    return customers(t, version).select("entity_id", F.inline(rows))


def documents(t: Tables, version: int) -> DataFrame:
    """(entity_id, page, json) of a version."""
    return assemble_documents(
        customers(t, version), order_records(t, version), neighbours(t, version), customer_features(t, version)
    )


def read_failures(t: Tables) -> DataFrame:
    """Customers whose read fails: those of nation 7."""
    return t.customer.filter(F.col("c_nationkey") == 7).select(
        F.col("c_custkey").alias("entity_id"), F.lit("RETRY_EXHAUSTED").alias("category"), F.lit("E7").alias("error_code"),
        F.concat(F.lit("cannot read "), F.col("c_custkey").cast("string")).alias("message"),
    )


def customer_ids(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("entityId"))
