"""Hard-negative mining by a secondary-sort shuffle.

Rows are packed into blocks of bounded size, anchors into chunks, and every block meets every chunk: the anchors are the stated query set, scored against all rows.
A score is packed into one key of bytes (anchor, descending score, kind, id), whose byte order is the order wanted.
``repartitionAndSortWithinPartitions`` sorts the keys of an anchor by Spark's external sort, and an iterator reads them once: a positive opens a window, each negative that
follows is emitted for the windows that are open, and a window closes when it is full or the score falls below its floor. No anchor's rows are held in memory.

The keys go through the shuffle twice. First each cell of a block and a chunk sends the few same-label rows of an anchor that can be its positives. With the positives known, a
cell sends only the negatives that can be among the first of a window; so a cell sends a bounded number of keys for each anchor, however many rows are close to it.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm.common import batches, meet
from kinfold.session import materialize

BLOCK_ROWS = 4096
BLOCK_NUMBERS = 1 << 19  # vector components in a block of rows, about
CHUNK_ANCHORS = 512
CHUNK_NUMBERS = 1 << 17  # vector components in a chunk of anchors, about
EXACT = float(1 << 50)  # scores below this are exact as doubles, with room for a row's place in one integer
LEAST, MOST = -(1 << 63), (1 << 63) - 1
POSITIVE, NEGATIVE = 0, 1
_KEY = struct.Struct(">QQBQ")
_FLIP = 1 << 63

PACKED = "ids binary, labels binary, vectors binary, width int"
POSITIVES = "anchor_id bigint, positive_id bigint, positive_score bigint"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def key_of(anchor: int, score: int, kind: int, row: int) -> bytes:
    """Bytes in the order (anchor, descending score, kind, row)."""
    return _KEY.pack(anchor + _FLIP, MOST - score, kind, row + _FLIP)


def parts_of(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, row = _KEY.unpack(key)
    return anchor - _FLIP, MOST - score, kind, row - _FLIP


def anchor_hash(key: bytes) -> int:
    return zlib.crc32(key[:8])


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part: id, label and vector are there and all components are finite numbers."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("vector"), fine.alias("fine"))
    return found.filter("id IS NOT NULL AND label IS NOT NULL AND fine").drop("fine")


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Whole numbers floor(256 x), as doubles, a row for each vector; shorter vectors end in zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(vectors), width))
    values = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def row_blocks(rows: DataFrame) -> DataFrame:
    """Blocks (ids, labels, vectors, width) of ``usable`` rows, by id within a block. Batches are cut, none are joined, so nothing is shuffled."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, stream):
            widest = int(batch.column("vector").value_lengths().to_numpy(zero_copy_only=False).max(initial=1))
            step = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, widest)))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                ids = part.column("id").to_numpy()
                order = np.argsort(ids, kind="stable")
                vectors = matrix(part.column("vector"))[order]
                fields = (ids[order].tobytes(), part.column("labels").to_numpy()[order].tobytes(), vectors.tobytes())
                yield pa.RecordBatch.from_pydict({**{c: [v] for c, v in zip(("ids", "labels", "vectors"), fields)}, "width": pa.array([vectors.shape[1]], pa.int32())})

    return rows.withColumnRenamed("label", "labels").mapInArrow(run, PACKED)


def anchor_chunks(anchors: DataFrame, chunks: int) -> DataFrame:
    """(chunk, ids, labels, vectors, width, wanted): anchors (id, label, vector, scores) in packed chunks; ``wanted`` has the scores of the anchors' positives, one list each."""
    listed = anchors.groupBy(F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("id", "label", "vector", "scores"))).alias("held")
    )

    def step(chunk, held):
        out = {c: [] for c in ("chunk", "ids", "labels", "vectors", "width", "wanted")}
        for k, members in zip(chunk, held):
            vectors = matrix(pa.array([m["vector"] for m in members], pa.list_(pa.float64())))
            ids, labels = (np.array([m[c] for m in members], np.int64).tobytes() for c in ("id", "label"))
            for name, v in zip(out, (k, ids, labels, vectors.tobytes(), vectors.shape[1], [m["scores"] for m in members])):
                out[name].append(v)
        return out

    return batches(listed, step, f"chunk int, {PACKED}, wanted array<array<bigint>>")


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all rows (down) and anchors (across) as whole numbers; beyond 64 bits they stop at the ends of the range."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    if np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(width, 1) < EXACT / BLOCK_ROWS:
        return (rows @ anchors.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(len(side), width) for side in (rows, anchors)]
    exact = whole[0].dot(whole[1].T) if width else np.zeros((len(rows), len(anchors)), dtype=object)
    return np.vectorize(lambda x: min(max(x, LEAST), MOST), otypes=[np.int64])(exact) if exact.size else exact.astype(np.int64)


def first_places(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` greatest values, the greatest first, equal ones by place."""
    if len(values) > n:
        edge = np.partition(values, len(values) - n)[len(values) - n]
        above = np.flatnonzero(values > edge)
        chosen = np.concatenate([above, np.flatnonzero(values == edge)[: n - len(above)]])
    else:
        chosen = np.arange(len(values))
    return chosen[np.lexsort((chosen, -values[chosen]))]


def cells(joined: DataFrame, pick) -> DataFrame:
    """(key) for the rows that ``pick`` takes from each anchor of each cell: pick(own label?, scores, wanted) gives places and kind."""

    names = [c for c in joined.columns if c != "chunk"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for k in range(len(batch)):
                cell = {c: batch.column(c)[k].as_py() for c in names}
                rows, anchors = ({c: np.frombuffer(cell[p + c], np.int64) for c in ("ids", "labels")} for p in ("", "a_"))
                vectors = [np.frombuffer(cell[p + "vectors"]).reshape(len(side["ids"]), cell[p + "width"]) for p, side in (("", rows), ("a_", anchors))]
                met = scores(*vectors)
                made = []
                for a, anchor in enumerate(anchors["ids"].tolist()):
                    mine = met[:, a]
                    places, kind = pick(rows["labels"] == anchors["labels"][a], rows["ids"] != anchor, mine, cell["a_wanted"][a])
                    made += [key_of(anchor, s, kind, i) for s, i in zip(mine[places].tolist(), rows["ids"][places].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["key"])

    return joined.mapInArrow(run, "key binary")


def positive_places(positives: int):
    def pick(same, other, mine, _):
        held = np.flatnonzero(same & other)
        return held[first_places(mine[held], positives)], POSITIVE

    return pick


def negative_places(negatives: int, low: int, high: int):
    """Negatives that are among the first of a cell for some window; the first of all cells together are among these."""

    def pick(same, other, mine, wanted):
        held = np.flatnonzero(~same & other)
        if not len(held) or not wanted:
            return held[:0], NEGATIVE
        ends = [window(score, low, high) for score in wanted]
        held = held[(mine[held] >= min(a for a, _ in ends)) & (mine[held] <= max(b for _, b in ends))]
        held = held[np.lexsort((held, -mine[held]))]
        falling = -mine[held]
        chosen = [np.arange(s := np.searchsorted(falling, -b), min(s + negatives, np.searchsorted(falling, -a, side="right"))) for a, b in ends]
        return held[np.unique(np.concatenate(chosen))], NEGATIVE

    return pick


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest negative score n with low * score <= 100 * n <= high * score, kept within 64 bits."""
    return max(-(-low * score // 100), LEAST + 1), min(high * score // 100, MOST)


def sorted_keys(keys, partitions: int):
    """The keys of an anchor together and in byte order, by Spark's external sort."""
    pairs = keys.rdd.map(lambda row: (bytes(row["key"]), None))
    return pairs.repartitionAndSortWithinPartitions(partitions, anchor_hash)


def first_positives(positives: int):
    def run(pairs) -> Iterator[tuple[int, int, int]]:
        current, seen = None, 0
        for key, _ in pairs:
            anchor, score, _, row = parts_of(key)
            current, seen = (anchor, seen) if anchor == current else (anchor, 0)
            if seen < positives:
                seen += 1
                yield anchor, row, score

    return run


def windows(negatives: int, low: int, high: int):
    def run(pairs) -> Iterator[tuple[int, int, int, int, int, int]]:
        current, opened = None, []  # [positive, its score, least score, greatest score, negatives so far]
        for key, _ in pairs:
            anchor, score, kind, row = parts_of(key)
            if anchor != current:
                current, opened = anchor, []
            if kind == POSITIVE:
                opened.append([row, score, *window(score, low, high), 0])
                continue
            opened = [w for w in opened if w[2] <= score and w[4] < negatives]
            for held in opened:
                if score <= held[3]:
                    held[4] += 1
                    yield anchor, held[0], held[4], row, held[1], score

    return run


def mine(
    rows: DataFrame,
    label: Column,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of every anchor and positive.

    ``label`` gives a row's label as a whole number, ``anchor`` says which rows are anchors. Scores are inner products of floor(256 x). An anchor's positives are the
    ``positives`` other rows of its label with the highest scores; a positive's negatives the first ``negatives`` rows of other labels whose score is ``low`` to ``high``
    (at most 100) percent of the positive's. Equal scores go by the smaller id. Rows without id or label, and vectors that are null or have a null or non-finite
    component, take no part; empty vectors score 0 and a shorter vector counts as if it ended in zeros. A row is no partner of rows with its own
    id; of several anchor rows with one id the one with the smallest label and vector is the anchor, while repeated candidates each count. An anchor without positives or
    windows without negatives give no rows, as does an empty table. Scores that leave 64 bits stop there. Other columns are not read.
    """
    spark = rows.sparkSession
    found = usable(rows, id_col, vector_col, label)
    blocks = materialize(row_blocks(found), "blocks")
    chosen = usable(rows.filter(anchor), id_col, vector_col, label).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one"))
    anchors = materialize(chosen.select("id", "one.*"), "anchors")
    n, numbers = anchors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    chunks = max(1, math.ceil(n / CHUNK_ANCHORS), math.ceil(numbers / CHUNK_NUMBERS))
    groups = max(1, math.ceil(blocks.count() / 16))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def scored(asked: DataFrame, pick) -> DataFrame:
        packed = materialize(anchor_chunks(asked, chunks), "chunks")
        beside = packed.select("chunk", *[F.col(c).alias(f"a_{c}") for c in packed.columns if c != "chunk"])
        return cells(meet(blocks, beside, "chunk", chunks, groups), pick)

    nothing = F.lit(None).cast("array<bigint>")
    first = sorted_keys(scored(anchors.withColumn("scores", nothing), positive_places(positives)), partitions)
    held = materialize(spark.createDataFrame(first.mapPartitions(first_positives(positives)), POSITIVES, verifySchema=False), "positives")
    wanted = held.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("scores"))
    met = scored(anchors.join(wanted, "id"), negative_places(negatives, low, high))
    opening = batches(
        held, lambda anchor_id, positive_id, positive_score: {"key": [key_of(a, s, POSITIVE, p) for a, p, s in zip(anchor_id, positive_id, positive_score)]}, "key binary"
    )
    pairs = sorted_keys(met.unionByName(opening), partitions)
    return spark.createDataFrame(pairs.mapPartitions(windows(negatives, low, high)), MINED, verifySchema=False)
