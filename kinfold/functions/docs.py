"""Scalars over response and entity JSON, all as column expressions.

Ids and 0/1 flags are read as VARIANT fields, because the JSON type matters there: `5` is an id and
`"5"` is not. Everything else is text, as in the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.session import unfold

DOCUMENT = (
    "struct<RESOLVED_ENTITY: struct<ENTITY_ID: variant, ENTITY_NAME: string, "
    "FEATURES: map<string, array<struct<FEAT_DESC: string, LIB_FEAT_ID: variant, USAGE_TYPE: string, "
    "USED_FOR_CAND: string, USED_FOR_SCORING: string, FEAT_DESC_VALUES: array<struct<FEAT_DESC: string, "
    "LIB_FEAT_ID: variant, USED_FOR_CAND: string, USED_FOR_SCORING: string>>>>>, "
    "RECORD_SUMMARY: array<struct<DATA_SOURCE: string, RECORD_COUNT: string>>, "
    "RECORDS: array<struct<DATA_SOURCE: string, RECORD_ID: string, MATCH_KEY: string, "
    "MATCH_LEVEL_CODE: string, ERRULE_CODE: string, FIRST_SEEN_DT: string, LAST_SEEN_DT: string>>>, "
    "RELATED_ENTITIES: array<struct<ENTITY_ID: variant, MATCH_LEVEL_CODE: string, MATCH_KEY: string, "
    "ERRULE_CODE: string, IS_AMBIGUOUS: variant, IS_DISCLOSED: variant>>, RELATION_COUNT: bigint>"
)

# Flag spellings (fixed values), compared in upper case.
YES = ["Y", "YES", "TRUE", "1"]
NO = ["N", "NO", "FALSE", "0"]



# --- small scalars ---------------------------------------------------------------------------

def variant_bigint(value: Column) -> Column:
    """The number when the JSON value is an integer, else null."""
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def text_flag(value: Column) -> Column:
    word = F.upper(F.trim(value))
    return F.when(word.isin(YES), F.lit(True)).when(word.isin(NO), F.lit(False))


def variant_flag(value: Column) -> Column:
    """An integer is true unless 0, a boolean stands for itself, text goes by its spelling."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint") != 0)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .otherwise(text_flag(F.try_variant_get(value, "$", "string")))
    )


def seen_at(value: Column) -> Column:
    """Timestamp text `yyyy-MM-dd HH:mm:ss[.fraction]`; anything else gives null."""
    text = F.trim(value)
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$")
    return F.when(shaped, F.try_to_timestamp(text))


def range_start(bounds: Column) -> Column:
    return _bound(bounds, 1)


def range_end(bounds: Column) -> Column:
    return _bound(bounds, 2)


def _bound(bounds: Column, group: int) -> Column:
    """`start-end` split at the last dash; other text fails the query."""
    shape = r"^(-?\d+)-(\d+)$"
    return F.when(
        bounds.rlike(shape), F.regexp_extract(bounds, shape, group).cast("bigint")
    ).otherwise(F.raise_error(F.concat(F.lit("bad range: "), F.coalesce(bounds, F.lit("null")))).cast("bigint"))


# --- responses -------------------------------------------------------------------------------

def affected_ids(response: Column) -> Column:
    """Array of integer ids in `AFFECTED_ENTITIES[].ENTITY_ID`; malformed JSON fails."""
    return _ids(response, "$.AFFECTED_ENTITIES", "$.ENTITY_ID")


def search_ids(response: Column) -> Column:
    """Array of integer ids in `RESOLVED_ENTITIES[].ENTITY.RESOLVED_ENTITY.ENTITY_ID`."""
    return _ids(response, "$.RESOLVED_ENTITIES", "$.ENTITY.RESOLVED_ENTITY.ENTITY_ID")


def _ids(response: Column, array_path: str, id_path: str) -> Column:
    items = F.try_variant_get(F.parse_json(response), array_path, "array<variant>")
    ids = F.transform(items, lambda e: variant_bigint(F.try_variant_get(e, id_path, "variant")))
    return F.filter(F.coalesce(ids, F.array().cast("array<bigint>")), lambda i: i.isNotNull())


# --- entity documents ------------------------------------------------------------------------

def _or_empty(items: Column, mapper: Column, ddl: str) -> Column:
    return F.when(items.isNull(), F.array().cast(ddl)).otherwise(mapper)


def record_summary(entity: Column) -> Column:
    """Source -> count, absent count 0; of two entries for one source the later one counts."""
    named = F.filter(entity["RECORD_SUMMARY"], lambda e: e["DATA_SOURCE"].isNotNull())
    pairs = F.transform(
        named,
        lambda e: F.struct(
            e["DATA_SOURCE"].alias("key"),
            F.coalesce(e["RECORD_COUNT"].try_cast("double").try_cast("int"), F.lit(0)).alias("value"),
        ),
    )
    last = F.filter(
        pairs,
        lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == e["key"]),
    )
    ddl = "array<struct<key: string, value: int>>"
    return F.map_from_entries(_or_empty(named, last, ddl))


def record_rows(entity: Column, entity_id: Column) -> Column:
    rows = F.transform(
        entity["RECORDS"],
        lambda r: F.struct(
            F.coalesce(r["DATA_SOURCE"], F.lit("")).alias("data_source"),
            F.coalesce(r["RECORD_ID"], F.lit("")).alias("record_id"),
            entity_id.alias("entity_id"),
            r["MATCH_KEY"].alias("match_key"),
            r["MATCH_LEVEL_CODE"].alias("match_level_code"),
            r["ERRULE_CODE"].alias("errule_code"),
            seen_at(r["FIRST_SEEN_DT"]).alias("first_seen_dt"),
            seen_at(r["LAST_SEEN_DT"]).alias("last_seen_dt"),
        ),
    )
    return _or_empty(
        entity["RECORDS"], rows,
        "array<struct<data_source: string, record_id: string, entity_id: bigint, match_key: string, "
        "match_level_code: string, errule_code: string, first_seen_dt: timestamp, last_seen_dt: timestamp>>",
    )


def relation_rows(related: Column, entity_id: Column) -> Column:
    """One row per related entity as (lo, hi); the key is forward when this entity is the low end."""
    ids = F.transform(related, lambda r: F.struct(variant_bigint(r["ENTITY_ID"]).alias("id"), r.alias("r")))
    known = F.filter(ids, lambda p: p["id"].isNotNull())
    rows = F.transform(
        known,
        lambda p: F.struct(
            F.least(entity_id, p["id"]).alias("entity_id_lo"),
            F.greatest(entity_id, p["id"]).alias("entity_id_hi"),
            p["r"]["MATCH_LEVEL_CODE"].alias("match_level_code"),
            F.when(entity_id <= p["id"], p["r"]["MATCH_KEY"]).alias("match_key"),
            F.when(entity_id > p["id"], p["r"]["MATCH_KEY"]).alias("rev_match_key"),
            p["r"]["ERRULE_CODE"].alias("errule_code"),
            variant_flag(p["r"]["IS_DISCLOSED"]).alias("is_disclosed"),
            variant_flag(p["r"]["IS_AMBIGUOUS"]).alias("is_ambiguous"),
        ),
    )
    return _or_empty(
        related, rows,
        "array<struct<entity_id_lo: bigint, entity_id_hi: bigint, match_level_code: string, "
        "match_key: string, rev_match_key: string, errule_code: string, is_disclosed: boolean, "
        "is_ambiguous: boolean>>",
    )


def _flag_pair(node: Column) -> Column:
    return F.struct(
        text_flag(node["USED_FOR_CAND"]).alias("cand"), text_flag(node["USED_FOR_SCORING"]).alias("score")
    )


def _feature_flags(feature: Column, feature_id: Column) -> Column:
    """Flags of the feature itself if it has any, else of its value with the same id, else of its
    first value."""
    own = _flag_pair(feature)
    values = feature["FEAT_DESC_VALUES"]
    same_id = F.filter(values, lambda v: variant_bigint(v["LIB_FEAT_ID"]) == feature_id)
    source = F.coalesce(F.get(same_id, F.lit(0)), F.get(values, F.lit(0)))
    return F.when(own["cand"].isNotNull() | own["score"].isNotNull(), own).otherwise(_flag_pair(source))


def feature_rows(entity: Column) -> Column:
    """The type -> features map as one flat array, each row naming its type."""

    def of_type(entry: Column) -> Column:
        def row(feature: Column) -> Column:
            feature_id = variant_bigint(feature["LIB_FEAT_ID"])
            flags = _feature_flags(feature, feature_id)
            return F.struct(
                entry["key"].alias("ftype_code"),
                feature_id.alias("lib_feat_id"),
                feature["FEAT_DESC"].alias("feat_desc"),
                feature["USAGE_TYPE"].alias("usage_type"),
                flags["cand"].alias("used_for_cand"),
                flags["score"].alias("used_for_scoring"),
            )

        return F.transform(entry["value"], row)

    typed = F.filter(F.map_entries(entity["FEATURES"]), lambda e: e["value"].isNotNull())
    return _or_empty(
        entity["FEATURES"], F.flatten(F.transform(typed, of_type)),
        "array<struct<ftype_code: string, lib_feat_id: bigint, feat_desc: string, usage_type: string, "
        "used_for_cand: boolean, used_for_scoring: boolean>>",
    )


def _line(*parts: Column) -> Column:
    """Parts joined by U+001F: null text is empty, a null flag false, a null number 0."""
    return F.concat_ws("\x1f", *parts)


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False)).cast("string")


def content_hash(
    entity_id: Column, name: Column, features: Column, records: Column, relations: Column, summary: Column
) -> Column:
    """SHA-256 over everything but the seen-dates. Each collection is sorted by its joined text, so
    the order inside the document does not matter."""
    head = F.array(_line(F.lit("ID"), entity_id.cast("string")), _line(F.lit("NAME"), _text(name)))
    record_text = F.transform(
        records,
        lambda r: _line(
            r["data_source"], r["record_id"], _text(r["match_key"]), _text(r["match_level_code"]),
            _text(r["errule_code"]),
        ),
    )
    relation_text = F.transform(
        relations,
        lambda r: _line(
            r["entity_id_lo"].cast("string"), r["entity_id_hi"].cast("string"), _text(r["match_key"]),
            _text(r["rev_match_key"]), _text(r["match_level_code"]), _text(r["errule_code"]),
            _flag(r["is_disclosed"]), _flag(r["is_ambiguous"]),
        ),
    )
    feature_text = F.transform(
        features,
        lambda f: _line(
            f["ftype_code"], F.coalesce(f["lib_feat_id"], F.lit(0)).cast("string"), _text(f["feat_desc"]),
            _text(f["usage_type"]), _flag(f["used_for_cand"]), _flag(f["used_for_scoring"]),
        ),
    )
    summary_text = F.transform(
        F.array_sort(F.map_entries(summary)), lambda e: _line(e["key"], e["value"].cast("string"))
    )
    sections = [F.array_sort(record_text), F.array_sort(relation_text), F.array_sort(feature_text), summary_text]
    return F.sha2(F.concat_ws("\x1e", head, *sections), 256)


def parse_documents(docs: DataFrame, json: str = "json", page: str | None = None) -> DataFrame:
    """Parse each document once into its row form: scalars plus the three nested row arrays.

    Page 0 counts for the whole entity, the pages after it count 0, so that sums over pages are right too.
    Malformed JSON and a document without an integer `ENTITY_ID` fail the query: an entity read that
    cannot be understood is a defect, not a row to skip.
    """
    root = F.from_json(F.col(json), DOCUMENT, {"mode": "FAILFAST"})
    parsed = docs.select(
        F.col(json).alias("entity_json"),
        (F.col(page) if page else F.lit(0)).cast("int").alias("page"),
        root.alias("_d"),
    )
    entity = F.col("_d.RESOLVED_ENTITY")
    raw_id = variant_bigint(entity["ENTITY_ID"])
    fail = F.raise_error(F.lit("document without RESOLVED_ENTITY.ENTITY_ID")).cast("bigint")
    rows = parsed.select(
        F.coalesce(raw_id, fail).alias("entity_id"), "page", "entity_json", "_d"
    ).select(
        "entity_id", "page", "entity_json",
        entity["ENTITY_NAME"].alias("entity_name"),
        feature_rows(entity).alias("features"),
        record_rows(entity, F.col("entity_id")).alias("records"),
        relation_rows(F.col("_d.RELATED_ENTITIES"), F.col("entity_id")).alias("relations"),
        record_summary(entity).alias("record_summary"), F.col("_d.RELATION_COUNT").alias("_relation_count"),
    )
    total = F.aggregate(F.map_values("record_summary"), F.lit(0), lambda a, b: a + b)
    listed = F.when(F.size("record_summary") > 0, total).otherwise(F.size("records"))
    related = F.coalesce(F.col("_relation_count"), F.size("relations"))
    header = F.col("page") == 0
    return rows.select(
        *[c for c in rows.columns if c != "_relation_count"],
        F.when(header, listed).otherwise(0).cast("int").alias("record_count"),
        F.when(header, related).otherwise(0).cast("int").alias("relation_count"),
        content_hash(
            F.col("entity_id"), F.col("entity_name"), F.col("features"), F.col("records"),
            F.col("relations"), F.col("record_summary"),
        ).alias("entity_hash"),
    )


def entity_frame(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "entity_id", "page", "entity_name", "record_count", "relation_count", "features",
        "record_summary", "entity_hash",
    )


def record_frame(parsed: DataFrame) -> DataFrame:
    return unfold(parsed, "records", "entity_id")


def relation_frame(parsed: DataFrame) -> DataFrame:
    return unfold(parsed, "relations", "entity_id_lo")


def document_frame(parsed: DataFrame) -> DataFrame:
    return parsed.select("entity_id", "page", "entity_json", "entity_hash")


def feature_frame(parsed: DataFrame) -> DataFrame:
    return unfold(parsed, "features", "ftype_code", "entity_id", "page")


