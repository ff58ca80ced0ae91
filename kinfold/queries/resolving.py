"""Queries over entity resolution: features, links, entities, relations, verbs, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinfold.functions import docs
from kinfold.operators import documents as ed, features as ft, linking, relating, searching
from kinfold.plans import mart as marts, resolver
from kinfold.plans.related import RelatedStore, profiles
from kinfold.queries import fixtures as fx
from kinfold.queries.registry import Tables, query
from kinfold.plans.store import ResolverStore
from kinfold.session import materialize, scratch, temporary
from kinfold.sources.inbox import write_inbox
from kinfold.streaming.feeder import drain, start_feeder
from kinfold.streaming.marts import start_mart_sync

# --- the same resolution in SQL --------------------------------------------------------------


def lines_sql(name: str, source: str) -> str:
    """CTE of (doc_id, text, ls): lower-case lines longer than 20 characters, in order."""
    return f"""{name} AS (
  SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: lower(trim(x))), lambda x: length(x) > 20) AS ls
  FROM {source})"""


def members_sql(tag: str, lines: str) -> str:
    """CTEs keys/links/members of a resolution: components by smallest reachable number."""
    return f"""
keys{tag} AS (
  SELECT doc_id, 'EXACT_TEXT' AS rule, sha256(lower(trim(text))) AS key FROM {lines}
  UNION ALL SELECT doc_id, 'SAME_OPENING', md5(ls[1] || chr(10) || ls[2]) FROM {lines} WHERE len(ls) >= 2
  UNION ALL SELECT doc_id, 'SAME_CLOSING', md5(ls[-2] || chr(10) || ls[-1]) FROM {lines} WHERE len(ls) >= 2),
links{tag} AS (
  SELECT lo, doc_id AS hi, keys{tag}.rule FROM keys{tag} JOIN (SELECT rule, key, min(doc_id) AS lo FROM keys{tag} GROUP BY rule, key) g
    ON keys{tag}.rule = g.rule AND keys{tag}.key = g.key WHERE doc_id > lo),
edges{tag} AS (SELECT lo AS a, hi AS b FROM links{tag} UNION SELECT hi, lo FROM links{tag}),
reach{tag} AS (
  SELECT doc_id AS node, doc_id AS seen FROM {lines}
  UNION SELECT reach{tag}.node, edges{tag}.b FROM reach{tag} JOIN edges{tag} ON edges{tag}.a = reach{tag}.seen),
members{tag} AS (SELECT node AS doc_id, min(seen) AS entity_id FROM reach{tag} GROUP BY node)"""


_R = f"WITH RECURSIVE {lines_sql('l', 'documents')}, {members_sql('', 'l')}"



def passages_sql(lines: str) -> str:
    return f"""SELECT doc_id, 'PASSAGE' AS ftype, md5(ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2]) AS value
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM {lines})"""


_PASSAGES = passages_sql("l")

_SHARED = f"""
vals AS (SELECT DISTINCT entity_id, ftype, value FROM (
  SELECT doc_id, 'LINE' AS ftype, md5(x) AS value FROM (SELECT doc_id, unnest(ls) AS x FROM l) UNION ALL {_PASSAGES}) JOIN members USING (doc_id)),
sized AS (
  SELECT entity_id, ftype, value, count(*) OVER (PARTITION BY ftype, value) AS n, min(entity_id) OVER (PARTITION BY ftype, value) AS anchor FROM vals),
evidence AS (SELECT anchor AS lo, entity_id AS hi, ftype, value FROM sized WHERE entity_id <> anchor),
scored AS (
  SELECT lo, hi, count(*) AS shared, CASE WHEN bool_or(ftype = 'PASSAGE') THEN 'POSSIBLY_SAME' ELSE 'POSSIBLY_RELATED' END AS level,
    CASE WHEN bool_or(ftype = 'PASSAGE') THEN 'LINES_MANY' ELSE 'LINES_FEW' END AS code,
    CASE WHEN bool_or(ftype = 'LINE') THEN '+LINE' ELSE '' END || CASE WHEN bool_or(ftype = 'PASSAGE') THEN '+PASSAGE' ELSE '' END AS match_key
  FROM evidence GROUP BY lo, hi)"""


# --- features, candidates, scores ------------------------------------------------------------


@query("resolve_features", f"""WITH {lines_sql('l', 'documents')}
SELECT doc_id AS record_seq, 'FULLTEXT' AS ftype, sha256(lower(trim(text))) AS value, true AS used_for_cand FROM l
UNION ALL SELECT doc_id, 'OPENING', md5(ls[1] || chr(10) || ls[2]), true FROM l WHERE len(ls) >= 2
UNION ALL SELECT doc_id, 'CLOSING', md5(ls[-2] || chr(10) || ls[-1]), true FROM l WHERE len(ls) >= 2
UNION ALL SELECT doc_id, 'LINE', md5(x), true FROM (SELECT DISTINCT doc_id, unnest(ls) AS x FROM l)""")
def resolve_features(t: Tables) -> DataFrame:
    rows = ft.feature_rows(ft.with_features(fx.records(t)))
    return rows.select("record_seq", "ftype", F.lower(F.hex("value")).alias("value"), "used_for_cand")


def _index(t: Tables) -> tuple[resolver.Resolution, DataFrame]:
    records = fx.records(t)
    resolution = resolver.resolve(records)
    return resolution, resolver.relation_index(records, resolution.moved)


@query("resolve_candidates", f"""{_R}, {_SHARED}
SELECT lo, hi, rule AS evidence, CAST(NULL AS VARCHAR) AS value FROM links UNION ALL SELECT lo, hi, ftype, value FROM evidence""")
def resolve_candidates(t: Tables) -> DataFrame:
    """Record links per rule and entity pairs per shared line or passage."""
    resolution, index = _index(t)
    pairs = relating.anchored_pairs(index)
    return resolution.links.select("lo", "hi", F.col("rule").alias("evidence"), F.lit(None).cast("string").alias("value")).unionByName(
        pairs.select("lo", "hi", F.col("ftype").alias("evidence"), F.lower(F.hex("value")).alias("value"))
    )


@query("resolve_scored_pairs", f"""{_R}, {_SHARED}
SELECT lo, hi, CASE rule WHEN 'EXACT_TEXT' THEN '+FULLTEXT' WHEN 'SAME_OPENING' THEN '+OPENING' ELSE '+CLOSING' END AS match_key,
  'RESOLVED' AS match_level_code, rule AS errule_code FROM links
UNION ALL SELECT lo, hi, match_key, level, code FROM scored""")
def resolve_scored_pairs(t: Tables) -> DataFrame:
    resolution, index = _index(t)
    merged = resolution.links.select(
        "lo", "hi", linking.match_key_of(F.col("rule")).alias("match_key"), F.lit("RESOLVED").alias("match_level_code"),
        F.col("rule").alias("errule_code"),
    )
    return merged.unionByName(resolver.relate_all(index).drop("shared"))


@query("resolve_entities", f"{_R} SELECT doc_id AS record_seq, CAST(doc_id AS VARCHAR) AS \"recordId\", entity_id FROM members")
def resolve_entities(t: Tables) -> DataFrame:
    return resolver.resolve(fx.records(t)).members.select("record_seq", "recordId", "entity_id")


@query("resolve_relationships", f"""{_R}, {_SHARED},
ends AS (SELECT lo AS id FROM scored WHERE level = 'POSSIBLY_SAME' UNION ALL SELECT hi FROM scored WHERE level = 'POSSIBLY_SAME'),
several AS (SELECT id FROM ends GROUP BY id HAVING count(*) > 1)
SELECT lo AS entity_id_lo, hi AS entity_id_hi, level AS match_level_code, match_key, code AS errule_code,
  level = 'POSSIBLY_SAME' AND (lo IN (SELECT id FROM several) OR hi IN (SELECT id FROM several)) AS is_ambiguous FROM scored""")
def resolve_relationships(t: Tables) -> DataFrame:
    _, index = _index(t)
    return resolver.entity_relations(index).select(
        "entity_id_lo", "entity_id_hi", "match_level_code", "match_key", "errule_code", "is_ambiguous"
    )


@query("resolve_relation_classes", f"""{_R}, {_SHARED},
held AS (SELECT ftype, value, list(entity_id ORDER BY entity_id) AS holders FROM sized WHERE n > 1 GROUP BY ftype, value),
classes AS (
  SELECT holders, min(value) AS class, count(*) AS shared, bool_or(ftype = 'PASSAGE') AS same,
    CASE WHEN bool_or(ftype = 'LINE') THEN '+LINE' ELSE '' END || CASE WHEN bool_or(ftype = 'PASSAGE') THEN '+PASSAGE' ELSE '' END AS match_key
  FROM held GROUP BY holders)
SELECT class, unnest(holders) AS entity_id, holders[1] AS anchor, len(holders) AS holders, shared, match_key,
  CASE WHEN same THEN 'POSSIBLY_SAME' ELSE 'POSSIBLY_RELATED' END AS match_level_code FROM classes""")
def resolve_relation_classes(t: Tables) -> DataFrame:
    """Who holds values together: every entity of every class, so every related pair is in one of them."""
    _, index = _index(t)
    classes = materialize(relating.relation_classes(index), "classes")
    return relating.class_members(index, classes).select(
        F.lower(F.hex("value")).alias("class"), "entity_id", "anchor", F.col("n").alias("holders"), "shared", "match_key", "match_level_code"
    )


# --- documents and reports -------------------------------------------------------------------


@query("entity_docs", f"""{_R}, {_SHARED},
rels AS (SELECT lo AS id, count(*) AS n FROM (SELECT lo FROM scored UNION ALL SELECT hi FROM scored) GROUP BY lo),
feats AS (
  SELECT entity_id AS id, count(*) AS n FROM (
    SELECT DISTINCT entity_id, 'V' AS t, value FROM vals WHERE ftype = 'LINE'
    UNION SELECT entity_id, rule, key FROM keys JOIN members USING (doc_id)) GROUP BY entity_id)
SELECT entity_id, min(source || ':' || CAST(entity_id AS VARCHAR)) FILTER (WHERE doc_id = entity_id) AS entity_name,
  CAST(count(*) AS INTEGER) AS record_count, CAST(coalesce(any_value(rels.n), 0) AS INTEGER) AS relation_count,
  CAST(any_value(feats.n) AS INTEGER) AS feature_count, CAST(count(DISTINCT source) AS INTEGER) AS sources
FROM members JOIN documents USING (doc_id) LEFT JOIN rels ON rels.id = entity_id LEFT JOIN feats ON feats.id = entity_id
GROUP BY entity_id""")
def entity_docs(t: Tables) -> DataFrame:
    """Documents of resolved entities, assembled and parsed again; the larger ones in several pages, whose header counts for all of them."""
    records = fx.records(t)
    resolution = resolver.resolve(records)
    index = resolver.relation_index(records, resolution.moved)
    documents = profiles(resolution.members, resolution.links, ft.with_features(records), resolver.entity_relations(index), page_size=40)
    parsed = docs.parse_documents(documents, page="page")
    return parsed.groupBy("entity_id").agg(
        F.max("entity_name").alias("entity_name"),
        F.max(F.when(F.col("page") == 0, F.col("record_count"))).alias("record_count"),
        F.max(F.when(F.col("page") == 0, F.col("relation_count"))).alias("relation_count"),
        F.sum(F.size("features")).cast("int").alias("feature_count"),
        F.max(F.size("record_summary")).alias("sources"),
    )


def _report_rows(t: Tables) -> DataFrame:
    members = resolver.resolve(fx.records(t)).members
    return members.select(F.col("dataSource").alias("data_source"), F.col("recordId").alias("record_id"), "entity_id")


@query("report_source_summary", f"""{_R}
SELECT source AS data_source, count(*) AS records, count(DISTINCT entity_id) AS entities FROM members JOIN documents USING (doc_id) GROUP BY source""")
def report_source_summary(t: Tables) -> DataFrame:
    return marts.source_summary(_report_rows(t))


@query("report_source_overlap", f"""{_R},
held AS (SELECT DISTINCT entity_id, source FROM members JOIN documents USING (doc_id))
SELECT a.source AS source_a, b.source AS source_b, count(*) AS entities FROM held a JOIN held b ON a.entity_id = b.entity_id AND a.source < b.source GROUP BY a.source, b.source""")
def report_source_overlap(t: Tables) -> DataFrame:
    return marts.source_overlap(_report_rows(t))


@query("report_entity_size", f"""{_R}
SELECT size, count(*) AS entities FROM (SELECT entity_id, count(*) AS size FROM members GROUP BY entity_id) GROUP BY size""")
def report_entity_size(t: Tables) -> DataFrame:
    return marts.entity_sizes(_report_rows(t))


# --- verbs -----------------------------------------------------------------------------------
# Before: all documents but the Spanish ones. The batch adds those and replaces the German ones, whose new
# text has another closing.

_NEW, _EDITED = "lang = 'es'", "lang = 'de'"
_TAIL = "this copy was revised in print\nand closes with another line"


def _edit(rows: DataFrame) -> DataFrame:
    text = F.when(F.expr(_EDITED), F.concat("text", F.lit("\n" + _TAIL))).otherwise(F.col("text"))
    return rows.withColumn("text", text)


def _as_records(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("doc_id").alias("record_seq"), F.col("source").alias("dataSource"), F.col("doc_id").cast("string").alias("recordId"),
        F.to_json(F.struct(F.col("text").alias("TEXT"))).alias("payload"),
    )


_SQL_TAIL = "'this copy was revised in print' || chr(10) || 'and closes with another line'"
_BEFORE_AFTER = f"""WITH RECURSIVE d0 AS (SELECT doc_id, text FROM documents WHERE NOT ({_NEW})),
d1 AS (SELECT doc_id, CASE WHEN {_EDITED} THEN text || chr(10) || {_SQL_TAIL} ELSE text END AS text FROM documents),
{lines_sql('l0', 'd0')}, {lines_sql('l1', 'd1')}, {members_sql('0', 'l0')}, {members_sql('1', 'l1')},
diff AS (
  SELECT unnest([a.entity_id, b.entity_id]) AS id FROM members0 a FULL JOIN members1 b ON a.doc_id = b.doc_id
  WHERE a.entity_id IS DISTINCT FROM b.entity_id)"""


def _add(t: Tables) -> tuple[DataFrame, resolver.Change]:
    state = resolver.resolve(_as_records(t.documents.filter(f"NOT ({_NEW})")))
    batch = _as_records(_edit(t.documents.filter(f"{_NEW} OR {_EDITED}")))
    _, change = resolver.add_records(state.keys, state.members, batch, "run-1")
    return state.members, change


@query("resolve_add_affected", f"""{_BEFORE_AFTER}
SELECT DISTINCT id AS "entityId", 'ADD' AS op, 'run-1' AS "runId" FROM (
  SELECT id FROM diff WHERE id IS NOT NULL
  UNION SELECT entity_id FROM members1 WHERE doc_id IN (SELECT doc_id FROM documents WHERE {_NEW} OR {_EDITED}))""")
def resolve_add_affected(t: Tables) -> DataFrame:
    return _add(t)[1].affected.select("entityId", "op", "runId")


@query("resolve_add_members", f"{_BEFORE_AFTER} SELECT doc_id AS record_seq, entity_id FROM members1")
def resolve_add_members(t: Tables) -> DataFrame:
    """The incremental result equals a rebuild of everything."""
    before, change = _add(t)
    return change.apply_to_members(before).select("record_seq", "entity_id")


@query("resolve_affected_diff", f"""{_BEFORE_AFTER}
SELECT CAST(coalesce(a.doc_id, b.doc_id) AS VARCHAR) AS "recordId", unnest(list_filter([a.entity_id, b.entity_id], lambda x: x IS NOT NULL)) AS "entityId"
FROM members0 a FULL JOIN members1 b ON a.doc_id = b.doc_id WHERE a.entity_id IS DISTINCT FROM b.entity_id""")
def resolve_affected_diff(t: Tables) -> DataFrame:
    before = resolver.resolve(_as_records(t.documents.filter(f"NOT ({_NEW})"))).members
    after = resolver.resolve(_as_records(_edit(t.documents))).members
    return resolver.affected_diff(before, after).select("recordId", "entityId")


# Deleted: the documents of the first copy in each group, which lets entities split and change their id,
# and keys no record has.
_DELETED = "n_chars < 2000 AND lang <> 'en'"


@query("resolve_delete_affected", f"""WITH RECURSIVE d0 AS (SELECT doc_id, text FROM documents),
d1 AS (SELECT doc_id, text FROM documents WHERE NOT ({_DELETED})),
{lines_sql('l0', 'd0')}, {lines_sql('l1', 'd1')}, {members_sql('0', 'l0')}, {members_sql('1', 'l1')}
SELECT DISTINCT unnest(list_filter([a.entity_id, b.entity_id], lambda x: x IS NOT NULL)) AS "entityId", 'DELETE' AS op
FROM members0 a FULL JOIN members1 b ON a.doc_id = b.doc_id WHERE a.entity_id IS DISTINCT FROM b.entity_id""")
def resolve_delete_affected(t: Tables) -> DataFrame:
    state = resolver.resolve(_as_records(t.documents))
    leaving = t.documents.filter(_DELETED).select(F.col("source").alias("dataSource"), F.col("doc_id").cast("string").alias("recordId"))
    absent = t.labels.select(F.lit("nowhere").alias("dataSource"), F.col("doc_id").cast("string").alias("recordId"))
    change = resolver.delete_records(state.keys, state.members, leaving.unionByName(absent), "run-2")
    return change.affected.select("entityId", "op")


def search_sql(asked: str, top: int) -> str:
    """CTEs up to ranked(request_id, rank, entity_id, shared, level) for the CTE ``asked`` of (doc_id, ftype, value)."""
    return f"""{_R},
held AS (
  SELECT DISTINCT entity_id, 'LINE' AS ftype, md5(x) AS value FROM (SELECT doc_id, unnest(ls) AS x FROM l) JOIN members USING (doc_id)
  UNION SELECT entity_id, ftype, value FROM ({_PASSAGES}) JOIN members USING (doc_id)
  UNION SELECT entity_id, rule, key FROM keys JOIN members USING (doc_id)),
{asked},
hits AS (
  SELECT asked.doc_id AS request_id, entity_id, count(*) AS shared, count(*) FILTER (WHERE asked.ftype NOT IN ('LINE', 'PASSAGE')) AS merging,
    bool_or(asked.ftype = 'PASSAGE') AS passage
  FROM asked JOIN held ON asked.ftype = held.ftype AND asked.value = held.value GROUP BY 1, 2),
ranked AS (
  SELECT request_id, entity_id, shared, row_number() OVER (PARTITION BY request_id ORDER BY merging > 0 DESC, shared DESC, entity_id) AS rank,
    CASE WHEN merging > 0 THEN 'RESOLVED' WHEN passage THEN 'POSSIBLY_SAME' ELSE 'POSSIBLY_RELATED' END AS level
  FROM hits QUALIFY rank <= {top})"""


def _loaded(t: Tables) -> ResolverStore:
    """A store with all documents, under their own numbers."""
    store = _store(t)
    store.add(_as_records(t.documents), "load", number="record_seq")
    return store


_ASKED_DOCUMENTS = f"""asked AS (SELECT * FROM (
  SELECT DISTINCT doc_id, 'LINE' AS ftype, md5(x) AS value FROM (SELECT doc_id, unnest(ls) AS x FROM l)
  UNION {_PASSAGES}
  UNION SELECT doc_id, rule, key FROM keys) WHERE doc_id % 100 = 0)"""


@query("resolve_search", f"""{search_sql(_ASKED_DOCUMENTS, 3)}
SELECT request_id, CAST(rank AS INTEGER) AS rank, entity_id, shared, level AS match_level_code FROM ranked""")
def resolve_search(t: Tables) -> DataFrame:
    """Documents whose id is divisible by 100 as requests against the stored postings of all entities, the three best for each."""
    requests = fx.records(t).filter("record_seq % 100 = 0").select(F.col("record_seq").alias("request_id"), "payload")
    return _loaded(t).find(requests, top=3)


_ASKED_ITEMS = f"""{lines_sql('b', '(SELECT item_id AS doc_id, text FROM benchmark)')},
asked AS (
  SELECT DISTINCT doc_id, 'LINE' AS ftype, md5(x) AS value FROM (SELECT doc_id, unnest(ls) AS x FROM b)
  UNION {passages_sql('b')}
  UNION SELECT doc_id, 'EXACT_TEXT', sha256(lower(trim(text))) FROM b
  UNION SELECT doc_id, 'SAME_OPENING', md5(ls[1] || chr(10) || ls[2]) FROM b WHERE len(ls) >= 2
  UNION SELECT doc_id, 'SAME_CLOSING', md5(ls[-2] || chr(10) || ls[-1]) FROM b WHERE len(ls) >= 2)"""


@query("resolve_search_results", f"""{search_sql(_ASKED_ITEMS, 10)}
SELECT md5(text) AS text_md5, coalesce(found, '') AS found FROM benchmark LEFT JOIN (
  SELECT request_id, string_agg(entity_id || ':' || shared || ':' || level, ',' ORDER BY rank) AS found FROM ranked GROUP BY request_id) ON request_id = item_id""")
def resolve_search_results(t: Tables) -> DataFrame:
    """Requests with their result JSON, read again: the ten best entities of each in order; every request has a list, found or not."""
    requests = t.benchmark.select(F.col("item_id").alias("request_id"), F.to_json(F.struct(F.col("text").alias("TEXT"))).alias("payload"))
    results = searching.search_results(requests, _loaded(t).find(requests, top=10))
    shape = "RESOLVED_ENTITIES array<struct<ENTITY: struct<RESOLVED_ENTITY: struct<ENTITY_ID: bigint>>, MATCH_INFO: struct<MATCH_LEVEL_CODE: string, SHARED: bigint>>>"
    listed = F.from_json("resultJson", shape)["RESOLVED_ENTITIES"]
    found = F.transform(listed, lambda e: F.concat_ws(":", e["ENTITY"]["RESOLVED_ENTITY"]["ENTITY_ID"], e["MATCH_INFO"]["SHARED"], e["MATCH_INFO"]["MATCH_LEVEL_CODE"]))
    return results.select(F.md5(F.get_json_object("requestJson", "$.TEXT")).alias("text_md5"), F.concat_ws(",", found).alias("found"))


_REDO_BLOCK = 8  # values with more holders wait in the queue
_REDO_LIMIT = 5


@query("resolve_redo_batch", f"""{_R}, {_SHARED},
taken AS (SELECT ftype, value FROM (SELECT DISTINCT ftype, value, n FROM sized WHERE n > {_REDO_BLOCK}) ORDER BY n DESC, ftype, value LIMIT {_REDO_LIMIT})
SELECT DISTINCT entity_id AS "entityId", 'REDO' AS op FROM sized SEMI JOIN taken USING (ftype, value)""")
def resolve_redo_batch(t: Tables) -> DataFrame:
    _, index = _index(t)
    taken = resolver.take_redo(relating.deferred_blocks(index, _REDO_BLOCK), _REDO_LIMIT)
    return resolver.redo_affected(index, taken, "run-3").select("entityId", "op")


@query("resolve_redo_drained", f"""{_R}, {_SHARED}
SELECT lo, hi, shared, level AS match_level_code FROM scored""")
def resolve_redo_drained(t: Tables) -> DataFrame:
    """After the queue is drained the relations equal those computed without deferring anything."""
    _, index = _index(t)
    done, _ = resolver.drain_redo(index, _REDO_LIMIT, _REDO_BLOCK)
    return resolver.relate(index, _REDO_BLOCK, done).select("lo", "hi", "shared", "match_level_code")


# --- stored state ----------------------------------------------------------------------------


def _store(t: Tables) -> ResolverStore:
    store = ResolverStore(t.spark, scratch(t.spark, "store"))
    store.create()
    store.register(t.documents.select(F.col("source").alias("data_source")).distinct())
    return store


@query("stream_resolve", f"""{_R},
groups AS (SELECT doc_id, entity_id, source FROM members JOIN documents USING (doc_id))
SELECT source AS "dataSource", CAST(doc_id AS VARCHAR) AS "recordId",
  min(doc_id) OVER (PARTITION BY entity_id) AS smallest, count(*) OVER (PARTITION BY entity_id) AS size FROM groups""")
def stream_resolve(t: Tables) -> DataFrame:
    """The inbox resolved batch by batch gives the same grouping as one resolve of everything."""
    store = _store(t)
    inbox, work = scratch(t.spark, "inbox"), scratch(t.spark, "feed")
    for lang in ("lang = 'en'", "lang <> 'en'"):
        write_inbox(_as_records(t.documents.filter(lang)), inbox, "append")
        feeder = start_feeder(
            t.spark, inbox, lambda batch, number: store.add(batch, f"batch-{number}"), f"{work}/cp", f"{work}/out", f"{work}/dead",
        )
        drain([feeder])
    members = store.read("member")
    sizes = members.groupBy("entity_id").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("recordId").cast("bigint")).alias("smallest"))
    return members.join(sizes, "entity_id").select("dataSource", "recordId", "smallest", "size")


@query("store_add_delete", f"""WITH RECURSIVE d1 AS (SELECT doc_id, text FROM documents WHERE NOT ({_DELETED})),
{lines_sql('l1', 'd1')}, {members_sql('1', 'l1')},
groups AS (SELECT doc_id, entity_id, source FROM members1 JOIN documents USING (doc_id))
SELECT source AS "dataSource", CAST(doc_id AS VARCHAR) AS "recordId",
  min(doc_id) OVER (PARTITION BY entity_id) AS smallest, count(*) OVER (PARTITION BY entity_id) AS size FROM groups""")
def store_add_delete(t: Tables) -> DataFrame:
    """One load and one delete job on stored state."""
    store = _store(t)
    store.add(_as_records(t.documents), "load")
    store.delete(_as_records(t.documents.filter(_DELETED)), "unload")
    members = store.read("member")
    sizes = members.groupBy("entity_id").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("recordId").cast("bigint")).alias("smallest"))
    return members.join(sizes, "entity_id").select("dataSource", "recordId", "smallest", "size")


_KEPT = f"""WITH RECURSIVE d1 AS (SELECT doc_id, text FROM documents WHERE NOT ({_DELETED})), {lines_sql('l', 'd1')}, {members_sql('', 'l')}, {_SHARED}"""


def _moved_store(t: Tables, on_step=lambda store, *affected: None) -> RelatedStore:
    """A load, an update to the final text with the rest, and an unload, each with its redo. ``on_step`` gets the outcome rows of both."""
    store = RelatedStore(t.spark, scratch(t.spark, "related"))
    store.create()
    store.register(t.documents.select(F.col("source").alias("data_source")).distinct())
    early = t.documents.filter("lang = 'en'")
    stale = early.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.reverse("text")).otherwise(F.col("text")))
    steps = [
        lambda: store.add(_as_records(stale), "load", "record_seq"),
        lambda: store.add(_as_records(early.filter("doc_id % 5 = 0").unionByName(t.documents.filter("lang IS DISTINCT FROM 'en'"))), "rest", "record_seq"),
        lambda: store.delete(_as_records(t.documents.filter(_DELETED)), "unload"),
    ]
    for step in steps:
        with temporary(t.spark):
            affected, (redone, _) = step(), store.drain("redo")
            on_step(store, *[rows for rows in (affected, redone) if rows is not None])
    return store


@query("store_relations", f"""{_KEPT},
ends AS (SELECT lo AS id FROM scored WHERE level = 'POSSIBLY_SAME' UNION ALL SELECT hi FROM scored WHERE level = 'POSSIBLY_SAME'),
several AS (SELECT id FROM ends GROUP BY id HAVING count(*) > 1)
SELECT lo AS entity_id_lo, hi AS entity_id_hi, level AS match_level_code, match_key, code AS errule_code,
  level = 'POSSIBLY_SAME' AND (lo IN (SELECT id FROM several) OR hi IN (SELECT id FROM several)) AS is_ambiguous FROM scored""")
def store_relations(t: Tables) -> DataFrame:
    """Relations kept by redo over loads, updates and deletes are those of one resolve of the final records."""
    return _moved_store(t).relations().select("entity_id_lo", "entity_id_hi", "match_level_code", "match_key", "errule_code", "is_ambiguous")


@query("mart_from_store", f"""{_KEPT},
rels AS (SELECT lo AS id, count(*) AS n FROM (SELECT lo FROM scored UNION ALL SELECT hi FROM scored) GROUP BY lo)
SELECT entity_id, min(source || ':' || CAST(entity_id AS VARCHAR)) FILTER (WHERE doc_id = entity_id) AS entity_name,
  CAST(count(*) AS INTEGER) AS record_count, CAST(coalesce(any_value(rels.n), 0) AS INTEGER) AS relation_count,
  (SELECT count(*) FROM scored) AS relations, (SELECT count(*) FROM members) AS records
FROM members JOIN documents USING (doc_id) LEFT JOIN rels ON rels.id = entity_id GROUP BY entity_id""")
def mart_from_store(t: Tables) -> DataFrame:
    """Store to documents to mart: the affected feed of loads, updates, deletes and redo drives the mart as a stream."""
    work = scratch(t.spark, "mart-feed")
    mart = marts.EntityMart(t.spark, f"{work}/mart")
    mart.create()

    def follow(store: RelatedStore, *affected: DataFrame) -> None:
        for rows in affected:
            rows.write.mode("append").parquet(f"{work}/feed")
        start_mart_sync(t.spark, f"{work}/feed", mart, store.fetch, f"{work}/cp", whole_relations=True).awaitTermination()

    _moved_store(t, follow)
    count = lambda name: mart.read(name, columns=[]).agg(F.count(F.lit(1))).scalar()
    # An entity of several pages has a row for each; its first one counts for all of them.
    return mart.read("entity", columns=["entity_name", "record_count", "relation_count"]).filter("page = 0").select(
        "entity_id", "entity_name", "record_count", "relation_count", count("relationship").alias("relations"), count("entity_record").alias("records")
    )
