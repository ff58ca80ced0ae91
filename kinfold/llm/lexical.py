"""Ranked lexical search over a length-stratified index.

The score of a document is a sum over the query's terms of w * ((10^9 tf) div (1000 tf + 8 m)), where m is the document's length normaliser. Documents of
equal m form a stratum; within it a term's postings stand by tf, so the impact, the second factor, is computed once for each (m, tf) and not for each posting, and the
last run of a term in a stratum gives the greatest impact that the term has there. For a query the strata are visited by their bound, the sum of these greatest impacts times
the weights, and the visit ends when the bound falls below the score of the k-th best document so far.

The index is a table: one row per segment of a bounded amount of text, with the documents of the segment in (m, place) order, its terms, and its postings in (term, stratum, tf) order.
Every document is in one segment, every term is indexed. Nothing is shuffled to build it; a stratum with very many documents spreads over all segments.
A query block meets every segment in a join on (block, group). A task keeps the k best of each query over all its segments, which also tightens the bounds; only these
are shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kinfold.llm.common import meet, pieces
from kinfold.session import materialize

BASE_LENGTH, LENGTH_SHARE = 100, 90  # m = 100 - 90 + (90 * n * N) div L
UNIT, TF_FACTOR, M_FACTOR = 1_000_000_000, 1000, 8  # impact = (10^9 * tf) div (1000 * tf + 8 * m)
SEGMENT_CHARS = 1 << 24  # text in a segment, about
SEGMENT_DOCS = 1 << 14
BLOCK_TERMS = 1 << 14  # (query, term) pairs in a block, about
GROUP_SEGMENTS = 8  # segments of a group that one copy of a query block meets
FIRST_VISIT = 16  # strata visited before the first look at the bounds; twice as many each time

# Bytes that stand in a term: ASCII letters and digits and all bytes beyond ASCII. A-Z alone are lower-cased.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

INDEX = (
    "n_docs int, ids array<bigint>, ms array<int>, terms array<string>, dfs array<int>, postings binary, tfs binary"
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, a piece of it at a time."""
    for part in pieces((text or "").encode("utf-8", "surrogatepass")):
        yield part.translate(_TABLE).split(b" ")


def term_count(text: str | None) -> int:
    return sum(len(found) - found.count(b"") for found in terms_of(text))


def normaliser(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """m for documents of ``n`` terms, of ``docs`` documents that hold ``length`` terms in all."""
    return np.array([BASE_LENGTH - LENGTH_SHARE + LENGTH_SHARE * x * docs // length for x in n.tolist()], dtype=np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * tf // (TF_FACTOR * tf + M_FACTOR * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass
class Segment:
    """Documents that are being indexed."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    ids: list[int | None] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    found: list[np.ndarray] = field(default_factory=list)  # per document: (term, tf) as terms, then tfs
    chars: int = 0

    def add(self, doc_id: int | None, text: str) -> None:
        counts: dict[int, int] = {}
        known = self.vocabulary
        for part in terms_of(text):
            numbers = [known.setdefault(t, len(known)) for t in part if t]
            terms, tfs = np.unique(np.array(numbers, np.int64), return_counts=True)
            if not counts:
                counts = dict(zip(terms.tolist(), tfs.tolist()))
            else:
                for t, tf in zip(terms.tolist(), tfs.tolist()):
                    counts[t] = counts.get(t, 0) + tf
        if counts:
            self.ids.append(doc_id)
            self.lengths.append(sum(counts.values()))
            self.found.append(np.array([list(counts), list(counts.values())], dtype=np.int64))
        self.chars += len(text)

    def row(self, docs: int, length: int) -> dict:
        """The index row: documents by m and then by their order among the ids (nulls last), postings by term, stratum and tf."""
        ms = normaliser(np.array(self.lengths, np.int64), docs, length)
        ids = pa.array(self.ids, pa.int64())
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
        order = np.lexsort((rank, ms))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = sorted(self.vocabulary)
        number = np.empty(len(names), np.int64)
        number[[self.vocabulary[t] for t in names]] = np.arange(len(names))
        owner = place[np.repeat(np.arange(len(self.found)), [f.shape[1] for f in self.found])]
        term, tf = np.concatenate(self.found, axis=1)
        term = number[term]
        at = np.lexsort((owner, tf, ms[order][owner], term))
        return {
            "n_docs": len(order), "ids": ids.take(pa.array(order)), "ms": ms[order].astype(np.int32), "terms": [t.decode("utf-8", "replace") for t in names],
            "dfs": np.bincount(term, minlength=len(names)).astype(np.int32), "postings": owner[at].astype(np.uint32).tobytes(), "tfs": tf[at].astype(np.uint32).tobytes(),
        }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_chars: int = SEGMENT_CHARS, segment_docs: int = SEGMENT_DOCS) -> tuple[DataFrame, int, int]:
    """(index, N, L): the stored segments, the number of documents with a term, and the number of all their terms.

    Null texts and texts without a term are in no segment. A null id is kept. Repeated rows are documents of their own.
    """
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lengths = [term_count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"docs": pa.array([sum(map(bool, lengths))], pa.int64()), "length": pa.array([sum(lengths)], pa.int64())})

    sums = rows.select("text").mapInArrow(count, "docs bigint, length bigint").agg(F.sum("docs"), F.sum("length")).first()
    n_docs, length = (x or 0 for x in sums)
    kind = rows.sparkSession.createDataFrame([], INDEX).schema
    fields = [
        ("n_docs", pa.int32()), ("ids", pa.list_(pa.int64())), ("ms", pa.list_(pa.int32())), ("terms", pa.list_(pa.string())),
        ("dfs", pa.list_(pa.int32())), ("postings", pa.binary()), ("tfs", pa.binary()),
    ]

    def packed(segment: Segment) -> pa.RecordBatch:
        made = segment.row(n_docs, length)
        columns = [pa.ListArray.from_arrays([0, len(v)], pa.array(v, t.value_type)) if pa.types.is_list(t) else pa.array([v], t) for (c, t) in fields for v in [made[c]]]
        return pa.RecordBatch.from_arrays(columns, names=[c for c, _ in fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = Segment()
        for batch in stream:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                segment.add(doc_id.as_py(), text.as_py())
                if segment.chars >= segment_chars or len(segment.ids) >= segment_docs:
                    if segment.ids:
                        yield packed(segment)
                    segment = Segment()
        if segment.ids:
            yield packed(segment)

    return materialize(rows.mapInArrow(run, kind), "index"), n_docs, length


@dataclass
class Opened:
    """An index row as arrays, for the terms that a block of queries asks for."""

    ids: list[int | None]
    ms: np.ndarray
    starts: np.ndarray  # of the strata among the documents, with the end of the last
    doc: np.ndarray  # of each posting of an asked term
    gain: np.ndarray  # impact of each posting
    bounds: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # term -> strata, greatest impacts, first and end posting in each

    @classmethod
    def of(cls, row: dict, asked: pa.Array) -> Opened:
        names = row["terms"]
        dfs = row["dfs"].to_numpy()
        ends = np.cumsum(dfs, dtype=np.int64)
        at = pc.index_in(asked, value_set=names)
        held = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        term = at.drop_null().to_numpy().astype(np.int64)
        ms = row["ms"].to_numpy().astype(np.int64)
        starts = np.concatenate([np.flatnonzero(np.diff(ms, prepend=-1)), [len(ms)]])
        stratum = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        sizes = dfs[term].astype(np.int64)
        rows = ranges(ends[term] - sizes, sizes)
        doc = np.frombuffer(row["postings"], np.uint32)[rows].astype(np.int64)
        tf = np.frombuffer(row["tfs"], np.uint32)[rows].astype(np.int64)
        owner = np.repeat(np.arange(len(term)), sizes)
        # A run has one term, stratum and tf: its impact is computed once.
        layer = stratum[doc]
        new_cell = np.concatenate([[True], (owner[1:] != owner[:-1]) | (layer[1:] != layer[:-1])]) if len(doc) else np.zeros(0, bool)
        opens = np.flatnonzero(new_cell | np.concatenate([[True], tf[1:] != tf[:-1]])) if len(doc) else np.zeros(0, np.int64)
        once = impact(tf[opens], ms[doc[opens]])
        gain = np.repeat(once, np.diff(np.append(opens, len(doc))))
        cells = np.flatnonzero(new_cell)
        cell_ends = np.append(cells[1:], len(doc))
        greatest = gain[cell_ends - 1] if len(cells) else gain  # tf ascends within a cell
        words = asked.take(pa.array(held)).to_pylist()
        cuts = np.searchsorted(owner[cells], np.arange(len(term) + 1))
        bounds = {w: (layer[cells[a:b]], greatest[a:b], cells[a:b], cell_ends[a:b]) for w, a, b in zip(words, cuts, cuts[1:])}
        return cls(row["ids"], ms, starts, doc, gain, bounds)

    def best(self, query: list[tuple[str, int]], k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of documents that can be among the k best, none with a score below ``floor`` or of 0."""
        cells = [(w, *self.bounds[t]) for t, w in query if w > 0 and t in self.bounds]
        if not cells:
            return []
        strata = np.concatenate([c[1] for c in cells])
        weights = np.repeat([c[0] for c in cells], [len(c[1]) for c in cells]).astype(np.int64)
        first, end = (np.concatenate([c[i] for c in cells]) for i in (3, 4))
        limit = np.zeros(len(self.starts) - 1, np.int64)
        np.add.at(limit, strata, weights * np.concatenate([c[2] for c in cells]))
        order = np.argsort(-limit, kind="stable")
        order = order[limit[order] >= max(floor, 1)]
        found: list[tuple[int, int]] = []
        at, step = 0, FIRST_VISIT
        while at < len(order) and limit[order[at]] >= floor:
            visit = np.zeros(len(limit), bool)
            visit[order[at : at + step]] = True
            chosen = np.flatnonzero(visit[strata])
            sizes = end[chosen] - first[chosen]
            rows = ranges(first[chosen], sizes)
            docs, where = np.unique(self.doc[rows], return_inverse=True)
            total = np.zeros(len(docs), np.int64)
            np.add.at(total, where, np.repeat(weights[chosen], sizes) * self.gain[rows])
            if len(total) > k:
                floor = max(floor, int(np.partition(total, len(total) - k)[len(total) - k]))
            fine = total >= max(floor, 1)
            found += zip(total[fine].tolist(), docs[fine].tolist())
            at, step = at + step, 2 * step
            if len(found) > k:
                floor = max(floor, heapq.nlargest(k, (s for s, _ in found))[-1])
        return found


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts`` and have ``sizes``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def query_blocks(items: DataFrame, index: DataFrame, n_docs: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(block, queries) and the number of blocks: each query's terms with their weights, in blocks of a bounded number of terms."""
    kind = items.schema[id_col].dataType.simpleString()
    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))

    def split(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [sorted({t for part in terms_of(x.as_py()) for t in part if t}) for x in batch.column("text")]
            sizes = pa.array([len(f) for f in found], pa.int32())
            owner = np.repeat(np.arange(len(found)), sizes.to_numpy())
            terms = pa.array([t.decode("utf-8", "replace") for f in found for t in f], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(owner, pa.int64())), terms], names=["item_id", "term"])

    asked = materialize(rows.mapInArrow(split, f"item_id {kind}, term string").distinct(), "asked")
    words = asked.select("term").distinct()
    counts = index.select(F.inline(F.arrays_zip("terms", "dfs"))).toDF("term", "df")
    df = counts.join(words, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weights = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    blocks = max(1, math.ceil(asked.count() / BLOCK_TERMS))
    weighted = asked.join(df.select("term", weights.cast("bigint").alias("w")), "term").groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    return weighted.groupBy(block.alias("block")).agg(F.collect_list(F.struct("item_id", "terms")).alias("queries")), blocks


def search(
    index: DataFrame, n_docs: int, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item, equal scores by ascending doc_id (a null one last).

    An item's terms count once. Items with a null id, null or empty text, or without a term that any document has give no rows; rows with one id are one item with the
    terms of all of them. Results are exact: bounds only decide what need not be visited. An empty table on either side gives no rows.
    """
    blocks, n_blocks = query_blocks(items, index, n_docs, id_col, text_col)
    kind = items.schema[id_col].dataType.simpleString()
    groups = max(1, math.ceil(index.count() / GROUP_SEGMENTS))
    met = meet(index, materialize(blocks, "queries"), "block", n_blocks, groups)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[object, list] = {}  # item -> the k best of this task, the worst first
        for batch in stream:
            for r in range(len(batch)):
                row = {c: batch.column(c)[r].values for c in ("ids", "ms", "terms", "dfs")} | {c: batch.column(c)[r].as_py() for c in ("postings", "tfs", "queries")}
                queries = [(q["item_id"], [(t["term"], t["w"]) for t in q["terms"]]) for q in row["queries"]]
                opened = Opened.of(row, pa.array(sorted({t for _, q in queries for t, _ in q}), pa.string()))
                for item, query in queries:
                    held = kept.get(item, [])
                    found = opened.best(query, k, held[0][0] if len(held) == k else 0)
                    if found:
                        found.sort(key=lambda x: (-x[0], x[1]))
                        edge = found[min(k, len(found)) - 1][0]
                        new = [(s, opened.ids[d].as_py()) for s, d in found if s >= edge]
                        kept[item] = sorted(heapq.nlargest(k, held + new, key=_order), key=_order)
            if len(kept) * k > 1 << 20:
                yield rows_of(kept)
                kept = {}
        if kept:
            yield rows_of(kept)

    arrow_kind = to_arrow_type(items.schema[id_col].dataType)

    def rows_of(kept: dict) -> pa.RecordBatch:
        listed = [(item, i, s) for item, held in kept.items() for s, i in held]
        columns = [pa.array(c, t) for c, t in zip(zip(*listed), (arrow_kind, pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    found = met.mapInArrow(run, f"item_id {kind}, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _order(found: tuple[int, int | None]) -> tuple[int, bool, int]:
    """Greater for the better one of two (score, id): the higher score, then the smaller id, a null one last."""
    score, doc_id = found
    return score, doc_id is not None, -(doc_id or 0)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, **columns: str) -> DataFrame:
    """``search`` over an index that is built for it. ``columns``: id_col and text_col of the documents."""
    index, n_docs, _ = build_index(docs, **columns)
    return search(index, n_docs, items, k)
