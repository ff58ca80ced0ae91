"""The registered query of each operator, over its whole table with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinfold.llm import langid, lexical, linededup, mixing, negatives, ordinal, packing, quality_rules, secrets, simhash, tiling, toxicity, urlfilter
from kinfold.llm.common import remainder
from kinfold.queries.registry import Tables
from kinfold.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(plan: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: plan(Tables(configure(spark), folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return register


def outside(mod: int, left: int) -> Callable[[str], Column]:
    """Training rows: those whose crc32 of the id, modulo ``mod``, is not ``left``."""
    return lambda key: remainder(key, mod) != left


@query("op1_toxicity")
def op1(t: Tables) -> DataFrame:
    model = toxicity.fit_toxicity(t.documents, t.labels, outside(5, 0))
    scored = toxicity.score_toxicity(t.documents, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op2_simhash")
def op2(t: Tables) -> DataFrame:
    return simhash.fingerprint_components(t.documents)


@query("op3_decontamination")
def op3(t: Tables) -> DataFrame:
    return tiling.document_verdicts(t.documents, tiling.leaks(t.documents, t.benchmark))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of three grades from the two labels: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


@query("op4_quality_classifier")
def op4(t: Tables) -> DataFrame:
    model = ordinal.fit_ordinal(t.documents, graded(t.labels), outside(5, 0))
    out = ordinal.grade_documents(t.documents, model, wanted=1)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "expected_grade", "tail", "kept")


# Labels for findings: what a format or a written key says for certain. Everything else is unlabelled and left to the forest.
KNOWN_SECRET = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-.+|eyJ[A-Za-z0-9_-]+)$"
NAMED_SECRET = r"(?i)(passw(or)?d|secret|token)\s*[=:]\s*[\"']?$"
NO_SECRET = r"^([0-9]+|[0-9]+(-[0-9]+)+|[A-Za-z]*[0-9]{1,2}|[A-Za-z]+([-_/][A-Za-z]+)+[0-9]*|[0-9]{1,2}[A-Za-z]+)$"


def finding_label() -> Column:
    written = F.concat_ws(" ", "before2", "before", F.when(F.col("lead").rlike("[A-Za-z]$"), F.concat("lead", F.lit("="))).otherwise(F.col("lead")))
    named = written.rlike(NAMED_SECRET)
    return F.when(F.col("candidate").rlike(KNOWN_SECRET) | named, 1).when(F.col("candidate").rlike(NO_SECRET), 0)


@query("op5_secret_scan")
def op5(t: Tables) -> DataFrame:
    found = secrets.scan(t.documents, finding_label(), remainder("doc_id", 5) != 0)
    return found.select("doc_id", "place", "nth", "candidate", (remainder("doc_id", 5) == 0).alias("held_out"), "probability", "is_secret")


HOST_SQL = r"""
    CASE WHEN rtrim(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.') <> ''
         THEN rtrim(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.') END
"""

OP6_SQL = rf"""
WITH captures AS (
  SELECT page_id, {HOST_SQL} AS host,
         DATE '2023-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7))::BIGINT % 730 AS INTEGER) AS day
  FROM pages
), names AS (
  SELECT DISTINCT host AS name FROM captures WHERE host IS NOT NULL
  UNION SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+$') FROM captures WHERE host LIKE '%.%'
), n AS (
  SELECT name, CAST(('0x' || substr(md5(name), 1, 7))::BIGINT AS BIGINT) AS a, CAST(('0x' || substr(md5(name), 8, 7))::BIGINT AS BIGINT) AS b FROM names
), entries AS (
  SELECT 'ads' AS list, name AS host, DATE '2023-01-01' + CAST(a % 400 AS INTEGER) AS day, 'add' AS action FROM n WHERE a % 3 = 0
  UNION ALL SELECT 'ads', name, DATE '2023-01-01' + CAST(a % 400 + 1 + b % 200 AS INTEGER), 'remove' FROM n WHERE a % 3 = 0
  UNION ALL SELECT 'ads', name, DATE '2023-01-01' + CAST(a % 400 + 61 + b % 200 AS INTEGER), 'add' FROM n WHERE a % 3 = 0 AND b % 2 = 0
  UNION ALL SELECT 'malware', name, DATE '2023-01-01' + CAST(b % 700 AS INTEGER), 'add' FROM n WHERE b % 5 = 0
), daily AS (
  SELECT list, host, day, min(CASE action WHEN 'add' THEN 1 ELSE 0 END) AS active FROM entries GROUP BY ALL
), spans AS (
  SELECT list, host, day AS valid_from, coalesce(until, DATE '9999-12-31') AS valid_to
  FROM (SELECT *, lead(day) OVER (PARTITION BY list, host ORDER BY day) AS until FROM daily) WHERE active = 1
), hits AS (
  SELECT page_id, list_sort(list_distinct(list(s.list))) AS lists
  FROM captures c JOIN spans s
    ON (c.host = s.host OR (ends_with(c.host, '.' || s.host) AND s.host LIKE '%.%')) AND c.day >= s.valid_from AND c.day < s.valid_to
  GROUP BY page_id
)
SELECT page_id, host, day, coalesce(array_to_string(lists, ','), '') AS lists, lists IS NOT NULL AS blocked
FROM captures LEFT JOIN hits USING (page_id)
"""


def digits(text: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(text), start, 7), 16, 10).cast("bigint")


def dated(days: Column) -> Column:
    return F.date_add(F.lit("2023-01-01").cast("date"), days.cast("int"))


@query("op6_url_filter", OP6_SQL)
def op6(t: Tables) -> DataFrame:
    """The pages carry no fetch time and there is no list among the tables: both are derived from them by digests."""
    captures = t.pages.select("page_id", "url", dated(digits(F.col("page_id").cast("string"), 1) % 730).alias("day"))
    hosts = captures.select(urlfilter.host_of(F.col("url")).alias("host")).filter("host IS NOT NULL").distinct()
    parents = hosts.filter(F.col("host").contains(".")).select(F.regexp_extract("host", r"[^.]+\.[^.]+$", 0).alias("host"))
    a, b = digits(F.col("host"), 1), digits(F.col("host"), 8)
    actions = F.array(
        _entry(a % 3 == 0, "ads", a % 400, "add"),
        _entry(a % 3 == 0, "ads", a % 400 + 1 + b % 200, "remove"),
        _entry((a % 3 == 0) & (b % 2 == 0), "ads", a % 400 + 61 + b % 200, "add"),
        _entry(b % 5 == 0, "malware", b % 700, "add"),
    )
    entries = hosts.unionByName(parents).distinct().select("host", F.explode(actions).alias("e")).filter("e IS NOT NULL").select("host", "e.*")
    return urlfilter.filter_captures(captures, entries)


def _entry(holds: Column, name: str, days: Column, action: str) -> Column:
    return F.when(holds, F.struct(F.lit(name).alias("list"), dated(days).alias("day"), F.lit(action).alias("action")))


@query("op7_language")
def op7(t: Tables) -> DataFrame:
    dictionaries, margins = langid.fit(t.documents, outside(4, 2)("doc_id"))
    found = langid.classify(t.documents, dictionaries, min_margin=margins)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, host, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 4) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS spot FROM rep) GROUP BY doc_id
), c AS (
  SELECT doc_id, host, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars, n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_words > 0 AND 10 * n_symbols > n_words AS f2, n_lines > 0 AND 10 * n_dup_lines > 3 * n_lines AS f3,
         n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words) AS f4
  FROM c
), h AS (
  SELECT host, count(*) AS n, sum(base_failed::INT) AS f1, sum(f2::INT) AS f2, sum(f3::INT) AS f3, sum(f4::INT) AS f4 FROM f GROUP BY host
), long AS (
  SELECT host, n, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS x FROM h
), m AS (
  SELECT rule, (sum(x / n) + 1) / (count(*) + 2) AS mean, (sum((x / n) * (x / n)) + 1) / (count(*) + 2) AS square FROM long GROUP BY rule
), p AS (
  SELECT rule, mean, greatest(mean * (1 - mean) / greatest(square - mean * mean, 1e-9) - 1, 2.0) AS strength FROM m
), v AS (
  SELECT host, n AS host_docs, bool_or((x + mean * strength) / (n + mean * strength + (1 - mean) * strength) > 0.5) AS host_failed
  FROM long JOIN p USING (rule) GROUP BY host, n
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_docs, host_failed,
       NOT base_failed AND NOT host_failed AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""


@query("op8_quality_rules", OP8_SQL)
def op8(t: Tables) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed host_docs host_failed kept".split()
    return quality_rules.apply_rules(t.documents).select(*columns)


@query("op9_line_dedup")
def op9(t: Tables) -> DataFrame:
    out = linededup.dedup_lines(t.documents)
    return out.select("doc_id", "text", F.length("text").alias("kept_chars"), "removed_chars")


@query("op10_packing")
def op10(t: Tables) -> DataFrame:
    return packing.pack(t.documents)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), c AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term
), s AS (
  SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS length FROM d WHERE len(ts) > 0
), m AS (
  SELECT r, doc_id, 10 + (90 * len(ts) * n_docs) // length AS m FROM d, s WHERE len(ts) > 0
), w AS (
  SELECT term, floor(1000 * ln((2.0 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, n_docs
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), t AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM t JOIN m USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


@query("op11_lexical_search", OP11_SQL)
def op11(t: Tables) -> DataFrame:
    return lexical.top_documents(t.documents, t.benchmark)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS words, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][src % 3 + 1] AS weight, greatest(ceil(words / 131072), ceil(n / 4096), 1)::BIGINT AS shards FROM s
), o AS (
  SELECT *, sum(words) OVER ()::DOUBLE AS total,
         coalesce(sum(3 * words) OVER (ORDER BY 3 * words / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
         sum(weight) OVER (ORDER BY 3 * words / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rest
  FROM w
), f AS (
  SELECT *, 3 * words < (total - before) / rest * weight AS is_full FROM o
), l AS (
  SELECT (max(total) - coalesce(sum(3 * words) FILTER (is_full), 0)) / sum(weight) FILTER (NOT is_full) AS level FROM f
), t AS (
  SELECT src, source, words, shards, is_full, CASE WHEN is_full THEN (3 * words)::DOUBLE ELSE level * weight END AS target FROM f, l
), p AS (
  SELECT doc_id, size, src, shards, ('0x' || substr(md5('12:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS spot
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), dealt AS (
  SELECT doc_id, size, src, spot % shards AS shard, spot // shards AS place FROM p
), parts AS (
  SELECT src, shard, ceil(sum(size) / 64)::BIGINT AS blocks FROM dealt GROUP BY src, shard
), b AS (
  SELECT src, sum(blocks)::BIGINT AS blocks FROM parts GROUP BY src
), claims AS (
  SELECT src, is_full, 3 * blocks AS cap, CASE WHEN words > 0 THEN target * blocks / words ELSE 0 END AS claim FROM t JOIN b USING (src)
), first AS (
  SELECT src, row_number() OVER (ORDER BY claim / (2 * k + 1) DESC, src, k) AS spot
  FROM (SELECT src, claim, unnest(range(cap)) AS k FROM claims WHERE NOT is_full AND claim > 0)
), house AS (
  SELECT floor(sum(claim) + 0.5) AS seats FROM claims WHERE NOT is_full
), quota AS (
  SELECT src, count(*) AS quota FROM first, house WHERE spot <= seats GROUP BY src
  UNION ALL SELECT src, cap FROM claims WHERE is_full
), second AS (
  SELECT src, shard, row_number() OVER (PARTITION BY src ORDER BY blocks / (2 * k + 1) DESC, shard, k) AS spot
  FROM (SELECT src, shard, blocks, unnest(range(3 * blocks)) AS k FROM parts)
), gives AS (
  SELECT src, shard, blocks, greatest(blocks, 1) AS n, coalesce(give, 0) AS give,
         ('0x' || substr(md5('12:start:' || src || ':' || shard), 1, 15))::BIGINT % greatest(blocks, 1) AS begin
  FROM parts LEFT JOIN (SELECT src, shard, count(*) AS give FROM second JOIN quota USING (src) WHERE spot <= quota GROUP BY src, shard) USING (src, shard)
), word_ends AS (
  SELECT *, sum(size) OVER (PARTITION BY src, shard ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM dealt
), cuts AS (
  SELECT e.*, n, give // n AS rounds, give % n AS extra, begin, stop - size AS start FROM word_ends e JOIN gives USING (src, shard)
), spread AS (
  SELECT *, ((stop // 64 + begin) * extra // n - begin * extra // n) * 64
            + (stop % 64) * ((stop // 64 + 1 + begin) * extra // n - (stop // 64 + begin) * extra // n) AS to_stop,
         ((start // 64 + begin) * extra // n - begin * extra // n) * 64
            + (start % 64) * ((start // 64 + 1 + begin) * extra // n - (start // 64 + begin) * extra // n) AS to_start
  FROM cuts
)
SELECT doc_id, source, size, words AS source_size, target, CASE WHEN size > 0 THEN rounds * size + to_stop - to_start ELSE 0 END::BIGINT AS taken,
       start AS first_word, shard
FROM spread JOIN t USING (src)
"""


@query("op12_mixing", OP12_SQL)
def op12(t: Tables) -> DataFrame:
    return mixing.mix(t.documents)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT anchor_id, positive_id, p.id AS negative_id, positive_score, p.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY p.score DESC, p.id)::INT AS rank
  FROM pos JOIN p USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * p.score AND 100 * p.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(t: Tables) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(t.embeddings, label, F.col("vec_id") % 100 == 0)
