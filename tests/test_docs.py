import hashlib
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kinfold.functions import docs
from kinfold.operators import documents as ed

PERSON = {
    "RESOLVED_ENTITY": {
        "ENTITY_ID": 40,
        "ENTITY_NAME": "Ada Quill",
        "FEATURES": {
            "NAME": [{"FEAT_DESC": "Ada Quill", "LIB_FEAT_ID": 4, "USAGE_TYPE": "PRIMARY", "FEAT_DESC_VALUES": [
                {"LIB_FEAT_ID": 9, "USED_FOR_CAND": "N", "USED_FOR_SCORING": "N"},
                {"LIB_FEAT_ID": 4, "USED_FOR_CAND": "Y", "USED_FOR_SCORING": "maybe"}]}],
            "DOB": [{"FEAT_DESC": "1980-02-03", "LIB_FEAT_ID": 5}],
        },
        "RECORD_SUMMARY": [{"DATA_SOURCE": "CRM", "RECORD_COUNT": 9}, {"DATA_SOURCE": "CRM", "RECORD_COUNT": 1}, {"DATA_SOURCE": "WEB"}],
        "RECORDS": [
            {"DATA_SOURCE": "CRM", "RECORD_ID": "r1", "MATCH_KEY": "+NAME", "FIRST_SEEN_DT": "2024-03-01 10:11:12.5", "LAST_SEEN_DT": "soon"},
            {"RECORD_ID": 7},
        ],
    },
    "RELATED_ENTITIES": [
        {"ENTITY_ID": 90, "MATCH_LEVEL_CODE": "POSSIBLY_SAME", "MATCH_KEY": "+DOB", "IS_AMBIGUOUS": 2, "IS_DISCLOSED": False},
        {"ENTITY_ID": 12, "MATCH_KEY": "+NAME", "IS_AMBIGUOUS": "no", "IS_DISCLOSED": "?"},
        {"ENTITY_ID": "13"},
    ],
}


def parse(spark, *bodies):
    texts = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return docs.parse_documents(spark.createDataFrame(texts, "json string"))


def test_projections(spark):
    row = parse(spark, PERSON).first()
    assert (row.entity_id, row.entity_name, row.record_count, row.relation_count) == (40, "Ada Quill", 1, 2)
    assert row.record_summary == {"CRM": 1, "WEB": 0}
    assert [(r.data_source, r.record_id) for r in row.records] == [("CRM", "r1"), ("", "7")]
    assert row.records[0].first_seen_dt.microsecond == 500000 and row.records[0].last_seen_dt is None
    low, high = sorted(row.relations, key=lambda r: r.entity_id_lo)
    assert (low.entity_id_lo, low.entity_id_hi, low.match_key, low.rev_match_key) == (12, 40, None, "+NAME")
    assert (low.is_ambiguous, low.is_disclosed) == (False, None)
    assert (high.match_key, high.rev_match_key, high.is_ambiguous, high.is_disclosed) == ("+DOB", None, True, False)
    flags = {f.ftype_code: (f.used_for_cand, f.used_for_scoring) for f in row.features}
    assert flags == {"NAME": (True, None), "DOB": (None, None)}


def test_empty_document_and_defects(spark):
    row = parse(spark, {"RESOLVED_ENTITY": {"ENTITY_ID": 1}}).first()
    assert (row.record_count, row.relation_count, row.records, row.features, row.record_summary) == (0, 0, [], [], {})
    for bad in ("{oops", {"RESOLVED_ENTITY": {}}, {"RESOLVED_ENTITY": {"ENTITY_ID": "5"}}):
        with pytest.raises(Exception):
            parse(spark, bad).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("{oops",)], "j string").select(docs.affected_ids(F.col("j"))).collect()


def test_hash_text_is_what_it_says(spark):
    body = {"RESOLVED_ENTITY": {"ENTITY_ID": 3, "RECORDS": [{"DATA_SOURCE": "B", "RECORD_ID": "2"}, {"DATA_SOURCE": "A", "RECORD_ID": "1", "MATCH_KEY": "+X"}]}}
    text = "\x1e".join(["ID\x1f3", "NAME\x1f", "A\x1f1\x1f+X\x1f\x1f", "B\x1f2\x1f\x1f\x1f"])
    assert parse(spark, body).first().entity_hash == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=6, deadline=None)
@given(st.randoms(use_true_random=False))
def test_hash_ignores_order_and_dates(spark, rng):
    mixed = json.loads(json.dumps(PERSON))
    entity = mixed["RESOLVED_ENTITY"]
    rng.shuffle(entity["RECORDS"])
    rng.shuffle(mixed["RELATED_ENTITIES"])
    entity["FEATURES"] = dict(rng.sample(sorted(entity["FEATURES"].items()), 2))
    for record in entity["RECORDS"]:
        record["LAST_SEEN_DT"] = "2025-01-01 00:00:00"
    changed = json.loads(json.dumps(PERSON))
    changed["RESOLVED_ENTITY"]["RECORDS"][0]["MATCH_KEY"] = "+OTHER"
    hashes = [r.entity_hash for r in parse(spark, PERSON, mixed, changed).collect()]
    assert len(set(hashes)) == 2


def test_pages_lose_nothing(spark):
    """An entity of 500 records in pages of 40 gives the same rows as one document, hot path included."""
    members = spark.range(520).selectExpr(
        "concat('s', id % 3) as data_source", "cast(id as string) as record_id", "case when id < 500 then 1 else id end as entity_id",
        "'+X' as match_key", "'RESOLVED' as match_level_code", "'R' as errule_code",
        "cast(null as timestamp) as first_seen_dt", "cast(null as timestamp) as last_seen_dt",
    )
    names = members.select("entity_id").distinct().selectExpr("entity_id", "concat('n', entity_id) as entity_name")
    pairs = spark.range(500, 520).selectExpr(
        "1L as entity_id_lo", "id as entity_id_hi", "'POSSIBLY_SAME' as match_level_code", "'+A' as match_key", "'+B' as rev_match_key",
        "'R' as errule_code", "false as is_disclosed", "true as is_ambiguous",
    )
    whole = docs.parse_documents(ed.assemble_documents(names, members, pairs), page="page")
    paged = docs.parse_documents(ed.assemble_documents(names, members, pairs, page_size=40, floor=10), page="page").cache()
    assert paged.filter("entity_id = 1").count() > 5
    assert paged.filter("entity_id = 1 and page = 0").count() == 1
    assert {r.entity_name for r in paged.filter("entity_id = 1").collect()} == {"n1"}
    for frame in (docs.record_frame, docs.relation_frame):
        assert sorted(map(str, frame(whole).collect())) == sorted(map(str, frame(paged).collect()))
    assert max(r.n for r in paged.selectExpr("size(records) as n").collect()) < 120


def test_fetch_kinds(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,)], "entityId bigint")
    found = spark.createDataFrame([(1, 0, "{}"), (3, 0, "{}"), (3, 1, "{}"), (9, 0, "{}")], "entity_id bigint, page int, json string")
    failed = spark.createDataFrame([(3, "BAD_INPUT", "E", "m")], "entity_id bigint, category string, error_code string, message string")
    rows = {(r.entityId, r.kind, r.json) for r in ed.fetch_entities(ids, found, failed).collect()}
    assert rows == {(1, "ENTITY", "{}"), (2, "GONE", None), (3, "ERROR", None)}
    broken = failed.withColumn("category", F.lit("SYSTEMIC"))
    with pytest.raises(Exception, match="systemic"):
        ed.fetch_entities(ids, found, broken).collect()
