"""Relations between entities: shared values, pair scores, ambiguity.

One rule for values of any size: each holder of a value is tied to the value's smallest holder. That is linear in the holders and leaves none
out. Pairs that meet only beside a smaller holder are in the classes (``relation_classes``, ``class_members``). Several agreements (lines in a row, two attributes) are values of their own (``features.relating_values``), so a score does not
depend on which entity happens to be the smallest holder of each single value. Blocks can be deferred (see
``plans/resolver.py``) and give the same evidence later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.operators.skew import HOT_FLOOR, hot_keys, salted_join
from kinfold.session import materialize

TYPES = ["LINE", "NAME", "ADDRESS", "PHONE", "EMAIL", "PASSAGE", "ATTRIBUTES"]


def entity_values(values: DataFrame, moved: DataFrame) -> DataFrame:
    """(entity_id, ftype, value), each once: copies inside an entity collapse before any pairing.

    Only records that moved under another id have a row in ``moved``; a left join keeps the rest.
    """
    joined = values.join(moved, "record_seq", "left")
    return joined.select(F.coalesce("entity_id", "record_seq").alias("entity_id"), "ftype", "value").distinct()


def block_index(values: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Values of two or more entities, each row with the block's size and anchor (smallest holder).
    ``values`` is read twice and should be a stored frame."""
    sizes = materialize(
        values.groupBy("ftype", "value").agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("anchor")).filter(F.col("n") > 1),
        "block-sizes",
    )
    hot = hot_keys(sizes, ["ftype", "value"], floor=floor)
    return salted_join(values, sizes, ["ftype", "value"], hot)


def deferred_blocks(index: DataFrame, over: int) -> DataFrame:
    """One row per value with more than ``over`` holders, to be related later."""
    large = index.filter((F.col("n") > over) & (F.col("entity_id") == F.col("anchor")))
    return large.select("ftype", "value", "n", "anchor")


def anchored_pairs(index: DataFrame) -> DataFrame:
    """(lo, hi, ftype, value): each holder of a value with the smallest one."""
    others = index.filter(F.col("entity_id") != F.col("anchor"))
    return others.select(F.col("anchor").alias("lo"), F.col("entity_id").alias("hi"), "ftype", "value")


def level_of(counts: dict[str, Column]) -> tuple[Column, Column]:
    """Match level and rule code from the number of shared values per feature type."""
    weak = counts["LINE"] + counts["ADDRESS"] + counts["PHONE"] + counts["EMAIL"]
    same = (counts["PASSAGE"] > 0) | (counts["ATTRIBUTES"] > 0)
    only_name = (counts["NAME"] > 0) & (weak == 0)
    level = (
        F.when(same, F.lit("POSSIBLY_SAME")).when(only_name, F.lit("NAME_ONLY")).otherwise(F.lit("POSSIBLY_RELATED"))
    )
    code = (
        F.when(counts["PASSAGE"] > 0, F.lit("LINES_MANY"))
        .when(counts["ATTRIBUTES"] > 0, F.lit("ATTRIBUTES_MANY"))
        .when(only_name, F.lit("NAME_ONLY"))
        .when(counts["LINE"] > 0, F.lit("LINES_FEW"))
        .otherwise(F.lit("ATTRIBUTE_ONE"))
    )
    return level, code


def score_pairs(evidence: DataFrame) -> DataFrame:
    """(lo, hi, shared, match_key, match_level_code, errule_code), one row per pair.

    Counting combines map-side, so a pair sharing many values costs one row per task.
    """
    return scored_counts(evidence.groupBy("lo", "hi").agg(*_by_type()), "lo", "hi")


def _by_type() -> list[Column]:
    return [F.count_if(F.col("ftype") == t).alias(f"_{t}") for t in TYPES]


def scored_counts(counted: DataFrame, *keys: str) -> DataFrame:
    """Scores from the number of shared values per feature type, in columns `_LINE`, `_NAME` and so on."""
    counts = {t: F.col(f"_{t}") for t in TYPES}
    parts = [F.when(counts[t] > 0, F.lit(f"+{t}")) for t in sorted(TYPES)]
    level, code = level_of(counts)
    return counted.select(
        *keys,
        sum((counts[t] for t in TYPES[1:]), counts[TYPES[0]]).alias("shared"),
        F.concat_ws("", *parts).alias("match_key"),
        level.alias("match_level_code"),
        code.alias("errule_code"),
    )


def relation_classes(index: DataFrame) -> DataFrame:
    """(ftype, value, anchor, n, shared, match_key, match_level_code, errule_code): one row per distinct set of two or more entities that hold some value together.

    The class is named by the smallest of its values; ``shared`` counts them. Sets are told apart by their size, smallest member and two 64-bit digests, which combine before the
    shuffle; so no set is gathered in one place, and a pair of entities that shares a value without its smallest holder is in a class all the same.
    """
    digests = [F.bit_xor(F.xxhash64("entity_id", F.lit(salt))).alias(f"_set{salt}") for salt in (1, 2)]
    sets = index.groupBy("ftype", "value", "anchor", "n").agg(*digests)
    counted = sets.groupBy("anchor", "n", "_set1", "_set2").agg(F.min(F.struct("value", "ftype")).alias("_class"), *_by_type())
    named = counted.withColumns({"ftype": F.col("_class.ftype"), "value": F.col("_class.value")})
    return scored_counts(named, "ftype", "value", "anchor", "n")


def class_members(index: DataFrame, classes: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """The rows of ``classes``, a stored frame, once for each entity_id of the class: linear in the holders, whatever their number."""
    hot = hot_keys(classes, ["ftype", "value"], floor=floor)
    return salted_join(index.select("ftype", "value", "entity_id"), classes, ["ftype", "value"], hot)


def relations(scored: DataFrame, floor: int = HOT_FLOOR, degree: DataFrame | None = None) -> DataFrame:
    """Scored pairs as relationship rows. Ambiguous: possibly the same as more than one entity.

    ``degree`` (id, n) says how many pairs of that level an entity has, where ``scored`` holds only some pairs of its ends.
    """
    scored = materialize(scored, "scored")
    same = scored.filter(F.col("match_level_code") == "POSSIBLY_SAME")
    if degree is None:
        ends = same.select(F.col("lo").alias("id")).unionByName(same.select(F.col("hi").alias("id")))
        degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    degree = materialize(degree.filter(F.col("n") > 1), "degree")
    hot = hot_keys(degree, ["id"], floor=floor)

    def flag(frame: DataFrame, end: str) -> DataFrame:
        several = degree.select(F.col("id").alias(end), F.lit(True).alias(f"_{end}"))
        return salted_join(frame, several, [end], hot, "left")

    flagged = flag(flag(same.select("lo", "hi"), "lo"), "hi")
    ambiguous = flagged.filter(F.col("_lo") | F.col("_hi")).select("lo", "hi", F.lit(True).alias("_a"))
    return scored.join(ambiguous, ["lo", "hi"], "left").select(
        F.col("lo").alias("entity_id_lo"), F.col("hi").alias("entity_id_hi"),
        "match_level_code", "match_key", F.col("match_key").alias("rev_match_key"), "errule_code",
        F.lit(False).alias("is_disclosed"), F.coalesce("_a", F.lit(False)).alias("is_ambiguous"),
    )
