"""Margins come from every held-out row, also beyond the 20,000 rows that were once drawn."""

import math

from pyspark.sql import functions as F

from kinfold.llm import langid
from kinfold.llm.common import hash_share

WORDS = {"aa": "kala tuma veri sona lahti poro mesa nuka", "bb": "strom grund pflicht werk zwang holz knecht markt"}


def test_margins_come_from_all_held_out_rows(spark):
    def text(lang):
        words = F.array(*[F.lit(w) for w in WORDS[lang].split()])
        odd = F.translate(F.hex(F.xxhash64("doc_id")), "0123456789", "ghijklmnop")
        return F.concat_ws(" ", *[F.get(words, F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(8)).cast("int")) for i in range(7)], odd)

    rows = spark.range(0, 110_000, 1, 8).withColumnRenamed("id", "doc_id")
    lang = F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")
    docs = rows.select("doc_id", lang.alias("lang"), F.when(F.col("doc_id") % 2 == 0, text("aa")).otherwise(text("bb")).alias("text"))
    dictionaries, margins = langid.fit(docs, F.lit(True))
    rest = docs.filter(hash_share("doc_id", 0.2, "margin"))
    found = rest.select("lang", langid.verdict(dictionaries, F.col("text")).alias("v"), F.length("text").alias("n")).select("lang", "v.*", "n").collect()
    assert len(found) > 20_000
    for at, least in enumerate(langid.CLASSES):
        below = langid.CLASSES[at + 1] if at + 1 < len(langid.CLASSES) else math.inf
        held = sorted(r.margin for r in found if r.lang_pred == r.lang and not r.rejected and least <= r.n + 2 < below)
        want = math.nextafter(held[int(langid.TAIL * len(held))], 0.0) if len(held) >= langid.LEAST else 0.0
        assert margins[at] == (least, want)


def test_a_fit_finds_each_verdict_once(spark, monkeypatch):
    """One Python step in the plan: a second one doubles the work and the Python workers of an executor."""
    plans = []

    def stored(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return materialize(frame, label)

    materialize = langid.materialize
    monkeypatch.setattr(langid, "materialize", stored)
    rows = [(i, "de" if i % 2 else "en", "das ist nicht gut" if i % 2 else "this is not good") for i in range(40)]
    langid.fit(spark.createDataFrame(rows, "doc_id int, lang string, text string"), F.lit(True))
    assert len(plans) == 1 and plans[0].count("ArrowEvalPython") == 1
