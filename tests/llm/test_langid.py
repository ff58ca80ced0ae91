import random
import zlib

import pytest
from pyspark.sql import functions as F

from kinfold.llm import langid
from kinfold.llm.queries import QUERIES, outside

DE, FR = "der die das und nicht ein schule wir sind heute da", "le la les des et une maison nous sommes ici bien"


@pytest.fixture(scope="module")
def model():
    return {"de": langid.plain(DE * 40), "fr": langid.plain(FR * 40)}


def test_dictionary_of_the_language_packs_smallest(model):
    pairs = tuple(model.items())
    de, fr = langid.sizes("Wir sind heute nicht da, und das", pairs)
    assert de < fr
    de, fr = langid.sizes("NOUS SOMMES | bien ici et la maison 12", pairs)
    assert fr < de


def test_edges(edge_docs, no_docs, model):
    rows = langid.classify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (2, 3, 4, 6):
        assert by_id[i].lang_pred == "und" and by_id[i].rejected and by_id[i].score == 0
    assert by_id[7].lang_pred == "fr" and 0 < by_id[7].score <= 1
    assert by_id[5].lang_pred in model
    assert langid.classify(no_docs, model).collect() == []
    assert {r.lang_pred for r in langid.classify(edge_docs, {}).collect()} == {"und"}
    kept = langid.recognised(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert not {2, 3, 4, 6} & {r.doc_id for r in kept.collect()}


def test_ties_go_to_the_first_language_and_are_rejected(spark):
    docs = spark.createDataFrame([(1, "zzz qqq")], "doc_id int, text string")
    row = langid.classify(docs, {"b": b"same words", "a": b"same words"}).first()
    assert (row.lang_pred, row.score, row.rejected) == ("b", 0.5, True)


def test_fit_without_labels(no_docs):
    assert langid.fit_dictionaries(no_docs, outside(4, 2)("doc_id")) == {}


def test_dictionaries_are_full_and_from_whole_texts(spark):
    """Ten long documents fill a dictionary like two thousand short ones do, and all parts of them are learnt from."""
    parts = [[f"{name}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)] for name in ("erst", "mitte", "ende")]
    long = " ".join(["vorwort"] * 100 + [w for part in parts for w in part * 16])
    rows = [(i, f"{long} {'x' * (i + 1)}", "rare") for i in range(10)] + [(100 + i, "un texte assez court", "often") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(4)
    made = langid.fit_dictionaries(docs, F.lit(True))
    assert list(made) == ["often", "rare"]
    assert [len(d) for d in made.values()] == [32_000, 32_000]
    assert all(made["rare"].count(name) > 500 for name in (b"erst", b"mitte", b"ende"))
    assert made["rare"].count(b"vorwort") < 100
    assert made == langid.fit_dictionaries(docs.repartition(3), F.lit(True))


def test_margins_reject_unlearned_languages_and_keep_clean_texts(spark):
    rng = random.Random(3)
    known = {"de": DE.split(), "fr": FR.split()}
    rows = [(i, " ".join(rng.choices(known[lang], k=60)), lang) for i in range(24_000) for lang in [("de", "fr")[i % 2]]]
    odd = [
        (-1 - i, " ".join("".join(rng.choices("bcdfghjkmpqvwxz", k=5)) for _ in range(50)) + " " + " ".join(rng.sample(known["de"], 3)), None) for i in range(200)
    ]
    docs = spark.createDataFrame(rows + odd, "doc_id int, text string, lang string").repartition(8)
    dictionaries, margins = langid.fit(docs, F.col("doc_id") % 4 != 2)
    assert [least for least, _ in margins] == list(langid.CLASSES)
    assert margins[0][1] == 0.0 < margins[2][1]  # no short text was seen: ties alone
    found = {r.doc_id: r.rejected for r in langid.classify(docs, dictionaries, min_margin=margins).collect()}
    assert sum(found[i] for i, *_ in rows) < 0.01 * len(rows)
    assert sum(found[i] for i, *_ in odd) > 0.9 * len(odd)
    assert sum(r.rejected for r in langid.classify(docs.filter("doc_id < 0"), dictionaries).collect()) < 0.9 * len(odd)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_language"](spark, folder).collect()
    assert len(rows) == len(want)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and want[r.doc_id]]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) > 0.95
