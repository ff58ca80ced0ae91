"""Entity documents: assembly from members, features and relations, and the fetch by id.

A document is cut into pages of about ``page_size`` items, so an entity that holds a large share of
all records never becomes one row. Nearly every entity has the single page 0, which is the whole
document. Of a larger one, page 0 is also the header: its `RECORD_SUMMARY` and `RELATION_COUNT` are those of the whole entity, counted in two
levels (partial counts in the tasks, then one row per entity and source). The pages after it carry the entity id and name and their part of the lists, and
no counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.skew import HOT_FLOOR, hot_keys, salted_join
from kinfold.session import materialize

PAGE_SIZE = 10_000

_RECORD = (
    "struct<DATA_SOURCE: string, RECORD_ID: string, MATCH_KEY: string, MATCH_LEVEL_CODE: string, "
    "ERRULE_CODE: string, FIRST_SEEN_DT: string, LAST_SEEN_DT: string>"
)
_RELATED = (
    "struct<ENTITY_ID: bigint, MATCH_LEVEL_CODE: string, MATCH_KEY: string, ERRULE_CODE: string, "
    "IS_AMBIGUOUS: int, IS_DISCLOSED: int>"
)
_FEATURE = (
    "struct<FTYPE: string, FEAT_DESC: string, LIB_FEAT_ID: bigint, USAGE_TYPE: string, "
    "USED_FOR_CAND: string, USED_FOR_SCORING: string>"
)


def _item(frame: DataFrame, entity: Column, kind: str, value: Column) -> DataFrame:
    shapes = {"name": "string", "rec": _RECORD, "rel": _RELATED, "feat": _FEATURE}
    return frame.select(
        entity.alias("entity_id"),
        *[(value if name == kind else F.lit(None)).cast(shape).alias(name) for name, shape in shapes.items()],
    )


def _seen(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS")


def _yn(value: Column) -> Column:
    return F.when(value, "Y").when(~value, "N")


def _record_items(members: DataFrame) -> DataFrame:
    return _item(members, F.col("entity_id"), "rec", F.struct(
        F.col("data_source"), F.col("record_id"), F.col("match_key"), F.col("match_level_code"),
        F.col("errule_code"), _seen(F.col("first_seen_dt")), _seen(F.col("last_seen_dt")),
    ))


def _relation_items(relations: DataFrame) -> DataFrame:
    """Each pair appears in the documents of both its ends, each with the key of its direction."""
    def side(end: str, other: str, key: str) -> Column:
        return F.struct(
            F.col(end).alias("entity_id"),
            F.struct(
                F.col(other).alias("ENTITY_ID"), F.col("match_level_code").alias("MATCH_LEVEL_CODE"),
                F.col(key).alias("MATCH_KEY"), F.col("errule_code").alias("ERRULE_CODE"),
                F.col("is_ambiguous").cast("int").alias("IS_AMBIGUOUS"),
                F.col("is_disclosed").cast("int").alias("IS_DISCLOSED"),
            ).alias("rel"),
        )

    both = F.array(side("entity_id_lo", "entity_id_hi", "match_key"), side("entity_id_hi", "entity_id_lo", "rev_match_key"))
    rows = relations.select(F.inline(both))
    return _item(rows, F.col("entity_id"), "rel", F.col("rel"))


def _feature_items(features: DataFrame) -> DataFrame:
    return _item(features, F.col("entity_id"), "feat", F.struct(
        F.col("ftype"), F.col("feat_desc"), F.col("lib_feat_id"), F.col("usage_type"),
        _yn(F.col("used_for_cand")), _yn(F.col("used_for_scoring")),
    ))


def _paged(items: DataFrame, page_size: int, floor: int) -> tuple[DataFrame, DataFrame | None]:
    """Add `page`: a hash of the item over the number of pages the entity needs. Also returns a header row for
    each entity of several pages (`_relations`, `_summary`: counts over all pages), None if there are none."""
    sized = items.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), F.count("rel").alias("_relations"))
    large = materialize(sized.filter(F.col("n") > page_size), "large-entities")
    if large.isEmpty():
        return items.withColumn("page", F.lit(0)), None
    pages = large.select("entity_id", F.ceil(F.col("n") / page_size).cast("int").alias("_pages"))
    joined = salted_join(items, pages, ["entity_id"], hot_keys(large, ["entity_id"], floor=floor), "left")
    # One row for each source of an entity, as many as there are registered sources.
    by_source = joined.filter(F.col("_pages").isNotNull() & F.col("rec.DATA_SOURCE").isNotNull()).groupBy(
        "entity_id", F.col("rec.DATA_SOURCE").alias("DATA_SOURCE")
    ).agg(F.count(F.lit(1)).cast("int").alias("RECORD_COUNT"))
    summary = by_source.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("DATA_SOURCE", "RECORD_COUNT"))).alias("_summary"))
    header = large.join(summary, "entity_id", "left").select("entity_id", "_relations", "_summary")
    page = F.pmod(F.xxhash64("rec", "rel", "feat"), F.coalesce("_pages", F.lit(1)))
    # The row of the entity itself goes to page 0, which therefore always exists.
    bare = F.col("rec").isNull() & F.col("rel").isNull() & F.col("feat").isNull()
    return joined.withColumn("page", F.when(bare, 0).otherwise(page).cast("int")).drop("_pages"), header


def assemble_documents(
    names: DataFrame,
    members: DataFrame,
    relations: DataFrame | None = None,
    features: DataFrame | None = None,
    page_size: int = PAGE_SIZE,
    floor: int = HOT_FLOOR,
    only: DataFrame | None = None,
) -> DataFrame:
    """(entity_id, page, json). ``names`` holds one (entity_id, entity_name) row per entity. The inputs are
    read twice (page count, then lists), so they should be stored frames. ``only`` (entity_id) leaves out the other ends of ``relations``."""
    items = _item(names, F.col("entity_id"), "name", F.col("entity_name")).unionByName(_record_items(members))
    if relations is not None:
        ends = _relation_items(relations)
        items = items.unionByName(ends if only is None else ends.join(only, "entity_id", "left_semi"))
    if features is not None:
        items = items.unionByName(_feature_items(features))
    # One shuffle gathers all three lists; a list holds about one page of items.
    paged, header = _paged(items, page_size, floor)
    gathered = paged.groupBy("entity_id", "page").agg(
        F.max("name").alias("entity_name"),
        F.array_sort(F.collect_list("rec")).alias("recs"),
        F.array_sort(F.collect_list("rel")).alias("rels"),
        F.array_sort(F.collect_list("feat")).alias("feats"),
    )
    sources = F.array_distinct(F.transform("recs", lambda r: r["DATA_SOURCE"]))
    summary = F.transform(sources, lambda s: F.struct(
        s.alias("DATA_SOURCE"),
        F.size(F.filter("recs", lambda r: r["DATA_SOURCE"] == s)).alias("RECORD_COUNT"),
    ))
    relation_count = F.lit(None).cast("bigint")  # a null field is left out of the JSON
    ftypes = F.array_distinct(F.transform("feats", lambda f: f["FTYPE"]))
    by_type = F.map_from_entries(F.transform(ftypes, lambda t: F.struct(
        t.alias("key"),
        F.transform(F.filter("feats", lambda f: f["FTYPE"] == t), lambda f: f.dropFields("FTYPE")).alias("value"),
    )))
    named = gathered
    if header is not None:
        # Later pages repeat the name; only entities of several pages take part in this join.
        of_large = names.withColumnRenamed("entity_name", "_name").join(header, "entity_id").withColumn("_large", F.lit(True))
        named = gathered.join(of_large, "entity_id", "left").withColumn("entity_name", F.coalesce("entity_name", "_name"))
        first = F.col("page") == 0
        whole = F.coalesce(F.when(first, F.col("_summary")), F.array().cast("array<struct<DATA_SOURCE: string, RECORD_COUNT: int>>"))
        summary = F.when(F.col("_large"), whole).otherwise(summary)
        relation_count = F.when(F.col("_large") & first, F.col("_relations"))
    document = F.struct(
        F.struct(
            F.col("entity_id").alias("ENTITY_ID"), F.col("entity_name").alias("ENTITY_NAME"),
            by_type.alias("FEATURES"), summary.alias("RECORD_SUMMARY"), F.col("recs").alias("RECORDS"),
        ).alias("RESOLVED_ENTITY"),
        F.col("rels").alias("RELATED_ENTITIES"), relation_count.alias("RELATION_COUNT"),
    )
    return named.select("entity_id", "page", F.to_json(document).alias("json"))


def fetch_entities(ids: DataFrame, documents: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Documents of the wanted ids: ENTITY rows (one per page), GONE for an id without a document,
    ERROR for an id whose read failed. A systemic failure stops the job.

    ``failures`` holds at most one (entity_id, category, error_code, message) row per id.
    """
    wanted = ids.select(F.col("entityId").alias("entity_id")).distinct()
    found = wanted.join(documents, "entity_id", "left")
    if failures is None:
        failures = ids.sparkSession.createDataFrame(
            [], "entity_id bigint, category string, error_code string, message string"
        )
    joined = found.join(failures, "entity_id", "left")
    stop = F.raise_error(F.concat(F.lit("systemic error while reading entities: "), F.coalesce("message", F.lit(""))))
    kind = (
        F.when(F.col("category") == "SYSTEMIC", stop.cast("string"))
        .when(F.col("category").isNotNull(), "ERROR")
        .when(F.col("json").isNull(), "GONE")
        .otherwise("ENTITY")
    )
    rows = joined.select(
        F.col("entity_id").alias("entityId"), F.coalesce("page", F.lit(0)).alias("page"), kind.alias("kind"),
        "json", "category", F.col("error_code").alias("errorCode"), "message",
    )
    # A failed read is one row, whatever number of pages the entity has.
    return rows.filter((F.col("kind") != "ERROR") | (F.col("page") == 0)).withColumn(
        "json", F.when(F.col("kind") == "ENTITY", F.col("json"))
    )


def tombstones(fetched: DataFrame) -> DataFrame:
    return fetched.filter(F.col("kind") == "GONE").select(F.col("entityId").alias("entity_id"))


def quarantine_rows(fetched: DataFrame) -> DataFrame:
    return fetched.filter(F.col("kind") == "ERROR").select(
        F.col("entityId").alias("entity_id"), "category", "message", F.col("errorCode").alias("raw")
    )
