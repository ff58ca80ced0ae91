"""Secret scans: a random forest that removes false positives, as column expressions and Spark ML only.

A candidate is a run of at least twelve token characters with a digit in it. Its features are its length, the transitions between
character classes, how many different characters it has, how much of its letters the corpus' own words cover, its path, and the words beside it. A forest trained on
labelled findings gives the probability that it is a secret.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import hash_share, share
from kinfold.session import materialize

# Patterns in the syntax of java.util.regex.
CANDIDATE = r"(?=[A-Za-z_+/=-]*[0-9])[A-Za-z0-9_+/=-]{12,}"
KEY_WORDS = r"(?i)(secret|token|passw|pwd|api.?key|auth|bearer|credential|private)"
HARMLESS_WORDS = r"(?i)(id|uuid|hash|sha|md5|commit|checksum|build|version|phone|tel|isbn)$"
TEST_PATH = r"(?i)(test|example|sample|doc|fixture|mock)"
FEATURES = (
    "length upper_share digit_share sign_share letter_digit digit_letter case_changes distinct_share hex_share longest_letters "
    "dictionary_share path_depth path_test assigned quoted key_word_near harmless_near before_known after_known"
).split()


def words_of(text: Column) -> Column:
    return F.split(F.trim(text), r"\s+")


def dictionary(docs: DataFrame, text_col: str = "text", min_docs: int = 20) -> DataFrame:
    """(word): lower-case words of four or more letters that stand in at least ``min_docs`` documents of the whole corpus."""
    words = F.array_distinct(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+"))
    counted = docs.select(F.explode(F.filter(words, lambda w: F.length(w) >= 4)).alias("word")).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("word")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, path, place, candidate, lead, before, before2, after): every candidate with the words beside it.

    ``place`` is the word's number in the text, ``lead`` what stands before the candidate within its word.
    """
    holds = docs.filter(F.col(text_col).rlike(CANDIDATE)).select(
        F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), words_of(F.col(text_col)).alias("words")
    )
    at = F.filter(
        F.transform("words", lambda w, i: F.when(w.rlike(CANDIDATE), i)), lambda i: i.isNotNull()
    )
    rows = holds.select("doc_id", "path", "words", F.explode(at).alias("place"))

    def beside(step: int) -> Column:
        return F.coalesce(F.get("words", F.col("place") + step), F.lit(""))

    rows = rows.select(
        "doc_id", "path", F.col("place"), beside(0).alias("word"), beside(-1).alias("before"), beside(-2).alias("before2"), beside(1).alias("after")
    )
    found = rows.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).alias("nth", "candidate"))
    lead = F.when(F.col("candidate").contains("="), F.regexp_extract("candidate", r"^(.*?)=(?=[^=])", 1)).otherwise(
        F.expr("substring(word, 1, greatest(instr(word, candidate) - 1, 0))")
    )
    bare = F.regexp_replace("candidate", r"^[A-Za-z_-]{2,}=(?=[^=])", "")
    return found.withColumn("lead", lead).withColumn("candidate", bare).drop("word")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the FEATURES columns as doubles, none of them null."""
    c = F.col("candidate")
    n = F.greatest(F.length(c), F.lit(1))
    distinct = F.size(F.array_distinct(F.split(c, "")))
    keyed = found.withColumn("_key", F.xxhash64("doc_id", "place", "nth", "candidate", "path"))
    # Letter runs of each distinct candidate, and the two neighbours, are looked up in the dictionary.
    runs = keyed.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(r"\p{L}{4,}"), F.lit(0))).alias("word")
    )
    covered = runs.join(known, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("_covered"))
    beside = keyed.select(F.explode(F.array(_bare("before"), _bare("after"))).alias("word")).distinct()
    near = materialize(beside.join(known, "word"), "near")
    joined = (
        keyed.join(covered, "candidate", "left")
        .join(near.select(F.col("word").alias("_b"), F.lit(1.0).alias("before_known")), _bare("before") == F.col("_b"), "left")
        .join(near.select(F.col("word").alias("_a"), F.lit(1.0).alias("after_known")), _bare("after") == F.col("_a"), "left")
    )
    context = F.concat_ws(" ", "before2", "before", "lead")
    values = {
        "length": F.length(c),
        "upper_share": _count(c, r"[A-Z]") / n,
        "digit_share": _count(c, r"[0-9]") / n,
        "sign_share": _count(c, r"[^A-Za-z0-9]") / n,
        "letter_digit": _count(c, r"(?<=[A-Za-z])(?=[0-9])") / n,
        "digit_letter": _count(c, r"(?<=[0-9])(?=[A-Za-z])") / n,
        "case_changes": (_count(c, r"(?<=[a-z])(?=[A-Z])") + _count(c, r"(?<=[A-Z])(?=[a-z])")) / n,
        "distinct_share": distinct / n,
        "hex_share": _count(c, r"[0-9a-f]") / n,
        "longest_letters": F.coalesce(
            F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"[A-Za-z]+"), F.lit(0)), lambda r: F.length(r))), F.lit(0)
        ),
        "dictionary_share": F.coalesce("_covered", F.lit(0)) / n,
        "path_depth": _count(F.coalesce("path", F.lit("")), "/"),
        "path_test": F.coalesce(F.col("path").rlike(TEST_PATH), F.lit(False)).cast("double"),
        "assigned": context.rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": F.col("lead").rlike(r"[\"']$").cast("double"),
        "key_word_near": context.rlike(KEY_WORDS).cast("double"),
        "harmless_near": F.trim(F.concat_ws(" ", "before2", "before")).rlike(HARMLESS_WORDS).cast("double"),
        "before_known": F.coalesce("before_known", F.lit(0.0)),
        "after_known": F.coalesce("after_known", F.lit(0.0)),
    }
    kept = [x for x in found.columns]
    return joined.select(*kept, *[v.cast("double").alias(name) for name, v in values.items()])


def _bare(column: str) -> Column:
    return F.lower(F.regexp_replace(column, r"[^\p{L}]+", ""))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def fit_forest(
    labelled: DataFrame, label_col: str = "label", max_rows: int = 20_000, trees: int = 20, depth: int = 6, seed: int = 7
) -> RandomForestClassificationModel | None:
    """A forest from about ``max_rows`` labelled findings with their features, chosen by a hash of the row. None unless both labels occur."""
    rows = labelled.filter(F.col(label_col).isNotNull())
    n, kinds = rows.agg(F.count(F.lit(1)), F.countDistinct(label_col)).first()
    if kinds < 2:
        return None
    key = rows.withColumn("_row", F.xxhash64("doc_id", "place", "candidate"))
    sample = key.filter(hash_share("_row", share(max_rows, n), "findings")).select(F.col(label_col).cast("double").alias("label"), *FEATURES)
    sample = materialize(sample, "findings")
    if sample.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(vectors)


def judge(featured: DataFrame, model: RandomForestClassificationModel | None, min_probability: float = 0.5) -> DataFrame:
    """``featured`` without its features, with ``probability`` and ``is_secret``; without a model both are null."""
    kept = [c for c in featured.columns if c not in FEATURES]
    if model is None:
        return featured.select(*kept, F.lit(None).cast("double").alias("probability"), F.lit(None).cast("boolean").alias("is_secret"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured))
    probability = vector_to_array("probability")[1]
    return scored.select(*kept, probability.alias("probability"), (probability >= min_probability).alias("is_secret"))


def scan(
    docs: DataFrame,
    labels: Column,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    max_rows: int = 20_000,
) -> DataFrame:
    """One row per candidate of the whole table: (doc_id, path, place, nth, candidate, ..., probability, is_secret).

    ``labels`` is an expression over a candidate's row that gives 1 (secret), 0 (not one) or null (unlabelled); the forest learns from labelled
    candidates where ``train`` holds. Null and empty texts have no candidates; a null path has no depth. Repeated rows give
    repeated findings. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    known = materialize(dictionary(docs, text_col), "dictionary")
    found = materialize(candidates(docs, id_col, text_col, path_col), "candidates")
    featured = materialize(features(found, known), "features")
    model = fit_forest(featured.filter(train).withColumn("label", labels), max_rows=max_rows)
    return judge(featured, model)
