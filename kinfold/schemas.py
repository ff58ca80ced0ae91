"""Fixed row shapes. One definition each, so that a writer and a reader cannot drift apart."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def struct(columns: str, **nested: T.DataType) -> T.StructType:
    """`name type, ...` of plain types (needs no running session); `name nested` looks up ``nested``."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, nested[name] if kind == "nested" else _TYPES[kind]) for name, kind in pairs])


INPUT = struct("dataSource string, recordId string, payload string")

OUTCOME = struct(
    "kind string, dataSource string, recordId string, entityId bigint, op string, runId string, "
    "requestJson string, resultJson string, payload string, category string, errorCode string, "
    "message string, attempts int"
)

AFFECTED_COLUMNS = ["dataSource", "recordId", "entityId", "op", "runId"]
SEARCH_COLUMNS = ["requestJson", "resultJson"]
ERROR_COLUMNS = [
    "dataSource", "recordId", "payload", "category", "errorCode", "message", "attempts",
]

# One row for each record that was called, beside its outcome rows.
CALL = "CALL"
CALL_COLUMNS = ["dataSource", "recordId", "op", "runId", "category", "attempts", "conflicts", "affected", "elapsedMs"]
LEDGER_ONLY = ["conflicts", "affected"]  # columns that outcome rows do not have

FETCH = struct(
    "entityId bigint, kind string, json string, category string, errorCode string, message string"
)

FEATURE_ROW = struct(
    "ftype_code string, lib_feat_id bigint, feat_desc string, usage_type string, used_for_cand boolean, "
    "used_for_scoring boolean"
)

# Business columns of the mart tables and their keys. `page` is 0 for every entity that fits one
# document page; see operators/documents.py.
MART = {
    "entity": (
        struct(
            "entity_id bigint, page int, entity_name string, record_count int, relation_count int, "
            "features nested, record_summary nested, entity_hash string",
            features=T.ArrayType(FEATURE_ROW), record_summary=T.MapType(T.StringType(), T.IntegerType()),
        ),
        ["entity_id", "page"],
    ),
    "entity_record": (
        struct(
            "data_source string, record_id string, entity_id bigint, match_key string, "
            "match_level_code string, errule_code string, first_seen_dt timestamp, "
            "last_seen_dt timestamp"
        ),
        ["data_source", "record_id"],
    ),
    "relationship": (
        struct(
            "entity_id_lo bigint, entity_id_hi bigint, match_level_code string, match_key string, "
            "rev_match_key string, errule_code string, is_disclosed boolean, is_ambiguous boolean"
        ),
        ["entity_id_lo", "entity_id_hi"],
    ),
    "entity_doc": (
        struct("entity_id bigint, page int, entity_json string, entity_hash string"),
        ["entity_id", "page"],
    ),
    "_quarantine": (
        struct("entity_id bigint, category string, message string, raw string"),
        ["entity_id", "category"],
    ),
}
MART_TABLES = ["entity", "entity_record", "relationship", "entity_doc"]
