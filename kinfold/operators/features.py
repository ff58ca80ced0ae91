"""Features of a record: what it can be found and compared by.

A feature value is kept as a digest of its normalized text, so that shuffles move 16 or 32 bytes
instead of the text. Everything here is a column expression over one record.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.session import spread, unfold

PASSAGE_LINES = 3  # lines in a row that make two entities possibly the same
MIN_LINE = 20  # a line counts as evidence only when it is longer than this


@dataclass(frozen=True)
class Attribute:
    """A payload key and the feature type it gives."""

    key: str
    ftype: str
    usage: str = ""
    candidate: bool = True
    scoring: bool = True


@dataclass(frozen=True)
class LinkRule:
    """Records that agree on every listed feature type are the same entity."""

    code: str
    ftypes: tuple[str, ...]

    @property
    def match_key(self) -> str:
        return "".join(f"+{f}" for f in self.ftypes)


# Keys read from a payload (fixed values of the input format).
ATTRIBUTES = [
    Attribute("NAME_FULL", "NAME"),
    Attribute("PRIMARY_NAME_FULL", "NAME", usage="PRIMARY"),
    Attribute("DATE_OF_BIRTH", "DOB"),
    Attribute("ADDR_FULL", "ADDRESS"),
    Attribute("PHONE_NUMBER", "PHONE"),
    Attribute("EMAIL_ADDRESS", "EMAIL"),
    Attribute("SSN_NUMBER", "SSN"),
]

# Resolving rules, all conjunctions of equal values. A record key per rule makes them exact without
# comparing records pairwise.
RULES = [
    LinkRule("EXACT_TEXT", ("FULLTEXT",)),
    LinkRule("SAME_OPENING", ("OPENING",)),
    LinkRule("SAME_CLOSING", ("CLOSING",)),
    LinkRule("NAME_DOB", ("NAME", "DOB")),
    LinkRule("NAME_ADDRESS", ("NAME", "ADDRESS")),
    LinkRule("NAME_EMAIL", ("NAME", "EMAIL")),
    LinkRule("NAME_PHONE", ("NAME", "PHONE")),
    LinkRule("SSN", ("SSN",)),
]
MATCH_KEY_OF = {rule.code: rule.match_key for rule in RULES}

# Feature types that relate entities without merging them. A shared date alone relates nobody.
RELATING = ["LINE", "NAME", "ADDRESS", "PHONE", "EMAIL"]
# Several agreements are keys of their own, so that they are found by equality too.
TOGETHER = {"PASSAGE": [], "ATTRIBUTES": [("ADDRESS", "PHONE"), ("ADDRESS", "EMAIL"), ("PHONE", "EMAIL")]}


def _feature(ftype: str, value: Column, text: Column, usage: str, candidate: bool, scoring: bool) -> Column:
    return F.struct(
        F.lit(ftype).alias("ftype"), value.alias("value"), text.alias("feat_desc"),
        F.lit(usage).alias("usage_type"), F.lit(candidate).alias("used_for_cand"),
        F.lit(scoring).alias("used_for_scoring"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def with_features(records: DataFrame, attributes: list[Attribute] = ATTRIBUTES) -> DataFrame:
    """(record_seq, dataSource, recordId, singles, lines, passages).

    ``singles`` holds the features of the whole record, ``lines`` its distinct long lines, ``passages`` the digests of
    any ``PASSAGE_LINES`` long lines in a row. They stay apart so that a plan which needs only one of them does not compute the others.
    """
    keys = ["TEXT", *[a.key for a in attributes]]
    body = F.from_json("payload", "struct<" + ", ".join(f"{k}: string" for k in keys) + ">")
    parsed = spread(records, "record_seq").select("record_seq", "dataSource", "recordId", body.alias("_b"))
    split = F.transform(F.split("_b.TEXT", "\n", -1), lambda x: F.lower(F.trim(x)))
    long = F.coalesce(F.filter(split, lambda x: F.length(x) > MIN_LINE), F.array().cast("array<string>"))
    lined = parsed.select("record_seq", "dataSource", "recordId", "_b", long.alias("_lines"))
    lines, size = F.col("_lines"), F.size("_lines")
    starts = F.when(size >= PASSAGE_LINES, F.sequence(F.lit(1), size - PASSAGE_LINES + 1)).otherwise(F.array().cast("array<int>"))
    passages = F.transform(starts, lambda i: _digest(F.concat_ws("\n", F.slice(lines, i, F.lit(PASSAGE_LINES)))))
    ends = lined.select(
        "*",
        F.sha2(F.lower(F.trim("_b.TEXT")), 256).alias("_whole"),
        F.when(size >= 2, F.md5(F.concat_ws("\n", lines[0], lines[1]))).alias("_opening"),
        F.when(size >= 2, F.md5(F.concat_ws("\n", lines[size - 2], lines[size - 1]))).alias("_closing"),
    )
    single = [
        _feature(ftype, F.unhex(column), F.col(column), "", True, True)
        for ftype, column in [("FULLTEXT", "_whole"), ("OPENING", "_opening"), ("CLOSING", "_closing")]
    ]
    for a in attributes:
        text = F.nullif(F.upper(F.regexp_replace(F.trim(F.col(f"_b.{a.key}")), r"\s+", " ")), F.lit(""))
        single.append(_feature(a.ftype, _digest(text), text, a.usage, a.candidate, a.scoring))
    known = F.filter(F.array(*single), lambda f: f["value"].isNotNull())
    return ends.select(
        "record_seq", "dataSource", "recordId", known.alias("singles"), F.array_distinct("_lines").alias("lines"),
        F.array_distinct(passages).alias("passages"),
    )


def feature_rows(featured: DataFrame) -> DataFrame:
    """One row per feature with its text and flags."""
    by_line = F.transform("lines", lambda x: _feature("LINE", _digest(x), x, "", True, True))
    return unfold(featured, F.concat("singles", by_line), "ftype", "record_seq")


def _values(ftypes: list[str] | None = None) -> Column:
    """The (ftype, value) structs of a record, each once, without the texts."""
    wanted = F.filter("singles", lambda f: f["ftype"].isin(ftypes)) if ftypes else F.col("singles")
    slim = F.transform(wanted, lambda f: F.struct(f["ftype"].alias("ftype"), f["value"].alias("value")))
    values = F.array_distinct(slim)
    if ftypes is None or "LINE" in ftypes:
        by_line = F.transform("lines", lambda x: F.struct(F.lit("LINE").alias("ftype"), _digest(x).alias("value")))
        values = F.concat(values, by_line)
    return values


def feature_values(featured: DataFrame, ftypes: list[str] | None = None) -> DataFrame:
    """(record_seq, ftype, value), each once per record, without the texts."""
    return unfold(featured, _values(ftypes), "ftype", "record_seq")


def _relating() -> Column:
    """The (ftype, value) structs that relate a record, several agreements included."""

    def typed(ftype: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(ftype).alias("ftype"), v.alias("value")))

    several = [typed("ATTRIBUTES", _combine(pair)) for pair in TOGETHER["ATTRIBUTES"]]
    together = F.array_distinct(F.concat(typed("PASSAGE", F.col("passages")), *several))
    return F.concat(_values(RELATING), together)


def relating_values(featured: DataFrame) -> DataFrame:
    """(record_seq, ftype, value): what relates entities, several agreements of one record included."""
    return unfold(featured, _relating(), "ftype", "record_seq")


def search_values(featured: DataFrame) -> DataFrame:
    """(record_seq, ftype, value): relating values, and link keys with the rule as their type. One pass, so that a record is parsed once."""
    return unfold(featured, F.concat(_relating(), _keys(RULES, "ftype", "value")), "ftype", "record_seq")


def batch_values(featured: DataFrame, rules: list[LinkRule] = RULES) -> DataFrame:
    """(record_seq, ftype, value, linking): ``search_values`` that tell the keys of ``rules`` apart, for jobs that need both and store them once."""

    def marked(values: Column, linking: bool) -> Column:
        return F.transform(values, lambda v: F.struct(v["ftype"].alias("ftype"), v["value"].alias("value"), F.lit(linking).alias("linking")))

    return unfold(featured, F.concat(marked(_relating(), False), marked(_keys(rules, "ftype", "value"), True)), "ftype", "record_seq")


def _combine(ftypes: tuple[str, ...]) -> Column:
    """All value combinations of one record for a rule, as digests."""

    def of_type(ftype: str) -> Column:
        return F.transform(F.filter("singles", lambda f: f["ftype"] == ftype), lambda f: f["value"])

    def pair(left: Column, right: Column) -> Column:
        return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.unhex(F.md5(F.concat(a, b))))))

    return reduce(pair, [of_type(f) for f in ftypes])


def _keys(rules: list[LinkRule], rule: str = "rule", key: str = "key") -> Column:
    """The link keys of a record, each once."""
    def keys_of(one: LinkRule) -> Column:
        return F.transform(_combine(one.ftypes), lambda k: F.struct(F.lit(one.code).alias(rule), k.alias(key)))

    return F.array_distinct(F.concat(*[keys_of(one) for one in rules]))


def link_keys(featured: DataFrame, rules: list[LinkRule] = RULES) -> DataFrame:
    """(record_seq, rule, key): records with an equal key under one rule are the same entity."""
    return unfold(featured, _keys(rules), "rule", "record_seq")
