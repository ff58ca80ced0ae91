"""Language ID by compression: the language whose dictionary packs a text smallest.

A language is a zstandard raw-content dictionary made of training texts. A text is encoded in blocks of a few thousand bytes, each with a
fresh start, so that the dictionary and not the text's own past decides, also in very long texts. The smallest sum wins; the
margin to the next one says how sure that is, and a narrow margin can be rejected.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import hash_share, share
from kinfold.operators.ordered import ranked_within
from kinfold.session import materialize

LETTERS = re.compile(r"[^\W\d_]+")
BLOCK = 4096  # bytes encoded with one start of the dictionary
LEVEL = 5
CLASSES = (0, 64, 256, 1024)  # least bytes of letters of the classes of length that have a margin of their own
TAIL = 0.002  # share of the clean texts of a class that its margin may reject
LEAST = 250  # clean texts that a class needs for a margin; with fewer, ties alone are rejected
PIECE = 160  # letters of a training text that go into a dictionary together
UNKNOWN = "und"
Margins = tuple[tuple[int, float], ...]  # (least bytes of letters, margin that must be exceeded), ascending from 0 bytes


def fit_dictionaries(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 400,
    dictionary_bytes: int = 32_000,
    languages: int = 1000,
) -> dict[str, bytes]:
    """Raw-content dictionaries by language, the most frequent first, from a bounded sample of the labelled rows.

    Of each of the ``languages`` most frequent labels at least about ``docs_per_language`` rows are taken, by a hash of the id, and more where these would hold
    less than four times ``dictionary_bytes``. Their whole texts are cut into pieces of ``PIECE`` letters, and pieces from all over them, by a hash of
    the piece, fill the dictionary to ``dictionary_bytes``; it is smaller only when all rows of the language hold less. So no more than a few times ``dictionary_bytes``
    of each language reach the driver, however long the texts are. Rows with null text or label are not used. No labelled row: no language.
    """
    rows = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = F.sum(F.length("text")).alias("size")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), size).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return {}
    chosen = F.lit(False)
    for lang, n, chars in counts:
        part = max(share(docs_per_language, n), share(4 * dictionary_bytes, chars))
        chosen = chosen | ((F.col("lang") == lang) & hash_share("id", part, "lang"))
    letters = F.trim(F.regexp_replace("text", r"[^\p{L}]+", " "))
    sample = rows.filter(chosen).select("lang", F.xxhash64("id", "text").alias("doc"), letters.alias("letters"))
    held = {lang: chars for lang, chars in sample.groupBy("lang").agg(F.sum(F.length("letters"))).collect()}
    wanted = F.lit(False)
    for lang, chars in held.items():
        # Half as much again as is needed, since pieces are drawn by a hash; all of them where there are few.
        wanted = wanted | ((F.col("lang") == lang) & hash_share("o", share(3 * dictionary_bytes // 2 + 20 * PIECE, chars), "piece"))
    starts = F.sequence(F.lit(0), F.greatest(F.length("letters") - 1, F.lit(0)), F.lit(PIECE))
    cut = sample.select("lang", "doc", "letters", F.explode(starts).alias("at"))
    cut = cut.select("lang", F.xxhash64("doc", "at").alias("o"), F.expr(f"substring(letters, at + 1, {PIECE})").alias("piece")).filter(wanted)
    filled: dict[str, list[bytes]] = {}
    for lang, _, piece in sorted(map(tuple, cut.collect())):
        filled.setdefault(lang, []).append(plain(piece).strip())
    joined = {lang: b" ".join(filled.get(lang, [])).strip()[-dictionary_bytes:] for lang, *_ in counts}
    return {lang: content for lang, content in joined.items() if content}


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...]):
    made = []
    for lang, content in model:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        made.append((lang, packer))
    return made


def plain(text: str) -> bytes:
    """The words of letters only, lower-cased, one space apart: case, digits and signs do not tell a language."""
    return " ".join(["", *LETTERS.findall(text.lower()), ""]).encode("utf-8", "surrogatepass")


def sizes(text: str, model: tuple[tuple[str, bytes], ...]) -> list[int]:
    """Packed bytes of the whole text for each language of the model."""
    return sizes_of_plain(plain(text), model)


def sizes_of_plain(raw: bytes, model: tuple[tuple[str, bytes], ...]) -> list[int]:
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    return [sum(len(packer.compress(b)) for b in blocks) for _, packer in _compressors(model)]


def fit(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> tuple[dict[str, bytes], Margins]:
    """(dictionaries, margins): dictionaries from four fifths of the training rows, margins from all rows of the rest.

    Clean texts are rows whose label is the language found. The margin of a class of length is the largest that rejects at most ``TAIL`` of its clean texts.
    """
    apart = hash_share(id_col, 0.2, "margin")
    dictionaries = fit_dictionaries(docs, train & (F.col(id_col).isNull() | ~apart), id_col, text_col, lang_col)
    rest = docs.filter(train & apart & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    found = rest.select(F.col(lang_col).alias("lang"), verdict(dictionaries, F.col(text_col)).alias("v"))
    least = F.greatest(*[F.when(F.col("v.size") >= c, F.lit(c)) for c in CLASSES], F.lit(0))
    # Filtered once stored: a filter on a verdict is moved below it, where another Python worker finds all verdicts a second time.
    right = F.when(F.expr("v.lang_pred = lang AND NOT v.rejected"), F.col("v.margin"))
    clean = materialize(found.select(least.alias("least"), right.alias("margin")), "clean").filter("margin IS NOT NULL")
    held = {row["least"]: row["n"] for row in clean.groupBy("least").agg(F.count(F.lit(1)).alias("n")).collect()}
    # One row of each class: the first that stays when the share of its clean texts below is rejected.
    at = F.lit(False)
    for c, n in held.items():
        at = at | ((F.col("least") == c) & (F.col("rank") == int(TAIL * n) + 1))
    bounds = dict(map(tuple, ranked_within(clean, ["least"], [F.col("margin")]).filter(at).select("least", "margin").collect()))
    return dictionaries, tuple((c, math.nextafter(bounds[c], 0.0) if held.get(c, 0) >= LEAST else 0.0) for c in CLASSES)


def verdict(dictionaries: dict[str, bytes], text: Column, min_margin: float | Margins = 0.0) -> Column:
    """The struct (lang_pred, score, margin, rejected, size) of a text column; see ``classify``. Size: bytes of ``plain``."""
    margins = min_margin if isinstance(min_margin, tuple) else ((0, min_margin),)
    model = tuple(dictionaries.items())

    def one(body):
        if not model or body is None or not LETTERS.search(body):
            return UNKNOWN, 0.0, 0.0, True, 0
        raw = plain(body)
        packed = sizes_of_plain(raw, model)
        best = min(packed)
        others = sorted(s - best for s in packed)[1:]
        margin = others[0] / best if others else 1.0
        score = 1 / (1 + sum(2.0 ** -min(extra, 64) for extra in others))
        return model[packed.index(best)][0], score, margin, margin <= [m for least, m in margins if least <= len(raw)][-1], len(raw)

    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_()), ("size", pa.int64())])

    @F.arrow_udf("lang_pred string, score double, margin double, rejected boolean, size bigint")
    def found(bodies: pa.Array) -> pa.Array:
        return pa.array([dict(zip(kind.names, one(b))) for b in bodies.to_pylist()], kind)

    return found(text)


def classify(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float | Margins = 0.0
) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for every row of ``docs``.

    ``margin`` is how many bytes the next best language needs more, as a share of the packed size; ``rejected`` is true when it is not above
    ``min_margin``, one number or the number for the text's length as ``fit`` gives it (so a tie is always rejected), or when nothing can be
    said. ``score`` is 1 / (1 + sum of 2^-extra bytes) over the other languages. Null texts, texts without a letter, and a model without languages give `und`, score 0, rejected. Equal sizes go to the
    language that comes first in ``dictionaries``, which is the most frequent one in training. Repeated rows stay; only the two columns are read.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), verdict(dictionaries, F.col(text_col), min_margin).alias("v"))
    return found.select("doc_id", "v.lang_pred", "v.score", "v.margin", "v.rejected")


def recognised(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float | Margins = 0.0) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    return docs.filter(~verdict(dictionaries, F.col(text_col), min_margin)["rejected"])
