"""Benchmark decontamination by greedy string tiling (Wise, 1993).

Benchmark items and documents are sequences of tokens, lower-case words without ASCII punctuation, each as a 64-bit hash. A document meets an item when they share a seed, a run of ``min_tile`` tokens. For
each such pair the longest common runs are marked first and tokens once marked are not used again, so the tiles cover
each item token at most once, in whatever order the passages stand in the document. Running Karp-Rabin finds the matches: windows of the current length
are hashed over the unmarked tokens of both sides, and equal hashes are compared and extended. An item whose tokens are covered to at least
``threshold`` is leaked.

The benchmark goes to the executors in blocks of a bounded number of tokens; each block is one pass over the documents. No document text is
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from kinfold.llm.common import batches, power_tables, word_hashes
from kinfold.session import materialize

BLOCK_TOKENS = 2_000_000  # of the benchmark held by a task at a time


def window_hashes(tokens: np.ndarray, n: int, free: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(starts, Karp-Rabin hashes) of all windows of ``n`` tokens, or of those that lie in ``free`` tokens only."""
    if len(tokens) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if free is None:
        starts = np.arange(len(tokens) - n + 1)
    else:
        taken = np.concatenate([[0], np.cumsum(~free)])
        starts = np.flatnonzero(taken[n:] == taken[:-n])
    power, inverse = power_tables(len(tokens) + 1)
    running = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * power[: len(tokens)], out=running[1:])
    return starts, (running[starts + n] - running[starts]) * inverse[starts]


@dataclass
class Block:
    """Some benchmark items as token hashes, and per seed length the seeds, sorted, with the items that hold them."""

    items: dict[object, np.ndarray]
    seeds: dict[int, tuple[np.ndarray, list[list]]]
    min_tile: int

    @classmethod
    def of(cls, rows: list[tuple[object, str]], min_tile: int) -> Block:
        items, holders = {}, {}
        for item, text in rows:
            tokens = word_hashes(text)
            if len(tokens):
                items[item] = tokens
                n = min(min_tile, len(tokens))
                for h in np.unique(window_hashes(tokens, n)[1]).tolist():
                    holders.setdefault(n, {}).setdefault(h, []).append(item)
        seeds = {n: (np.array(sorted(held), dtype=np.uint64), [held[h] for h in sorted(held)]) for n, held in holders.items()}
        return cls(items, seeds, min_tile)

    def met(self, tokens: np.ndarray) -> set:
        """Items that share a seed with the document."""
        found: set = set()
        for n, (hashes, held) in self.seeds.items():
            mine = window_hashes(tokens, n)[1]
            at = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
            for k in np.unique(at[hashes[at] == mine]).tolist():
                found.update(held[k])
        return found

    def covered(self, text: str | None, threshold: float) -> Iterator[tuple[object, float, int]]:
        """(item, coverage, number of tiles) of each item that the text covers to the threshold."""
        tokens = word_hashes(text)
        for item in sorted(self.met(tokens)):
            target = self.items[item]
            tiles = tile(target, tokens, min(self.min_tile, len(target)))
            coverage = sum(n for _, _, n in tiles) / len(target)
            if coverage >= threshold:
                yield item, coverage, len(tiles)


def tile(item: np.ndarray, doc: np.ndarray, min_tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, doc start, length), the longest first.

    The search length starts at the longest window that both sides share (found by halving) and falls to ``min_tile``; among matches of one length the
    one that stands first in the item, then in the document, is taken first.
    """
    tiles: list[tuple[int, int, int]] = []
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    length = len(item)
    while length >= min_tile:
        marked = _mark(item, doc, in_item, in_doc, length)
        tiles.extend((i, d, length) for i, d in marked)
        length = length - 1 if marked else _longest(item, doc, in_item, in_doc, min_tile, length - 1)
    return tiles


def _longest(item, doc, in_item, in_doc, low: int, high: int) -> int:
    """The greatest window length in [low, high] that both sides share, or less than ``low`` if none."""
    best = low - 1
    while low <= high:
        mid = (low + high) // 2
        a, b = window_hashes(item, mid, ~in_item)[1], window_hashes(doc, mid, ~in_doc)[1]
        if np.isin(a, b).any():
            best, low = mid, mid + 1
        else:
            high = mid - 1
    return best


def _mark(item, doc, in_item, in_doc, n: int) -> list[tuple[int, int]]:
    """(item start, doc start) of the equal windows of ``n`` tokens that are marked now. Each free item window, in order, takes the first free
    window of the document that equals it, so none is left of this length."""
    i_start, i_hash = window_hashes(item, n, ~in_item)
    d_start, d_hash = window_hashes(doc, n, ~in_doc)
    both = np.isin(d_hash, i_hash)
    places: dict[int, list[int]] = {}
    for d, h in zip(d_start[both].tolist(), d_hash[both].tolist()):
        places.setdefault(h, []).append(d)
    first: dict[int, int] = {}
    found = []
    for i, h in zip(i_start.tolist(), i_hash.tolist()):
        if in_item[i : i + n].any():
            continue
        options, at = places.get(h, []), first.get(h, 0)
        while at < len(options) and in_doc[options[at] : options[at] + n].any():
            at += 1  # a marked window never becomes free again
        first[h] = at
        for d in (options[k] for k in range(at, len(options))):
            if not in_doc[d : d + n].any() and np.array_equal(item[i : i + n], doc[d : d + n]):
                in_item[i : i + n] = True
                in_doc[d : d + n] = True
                found.append((i, d))
                break
    return found


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_tile: int = 5,
    threshold: float = 0.5,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles): every document and every item it covers to at least ``threshold``.

    ``coverage`` is the share of the item's tokens in tiles. Items shorter than ``min_tile`` tokens need one run with all of them. Null and empty texts on either side
    match nothing; a repeated item id counts as one item with the texts of its first row by text order; repeated documents each give their rows. An empty benchmark or
    table gives no rows.
    """
    kinds = (docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString())
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(held):
        def run(id, text):
            out = {"id": [], "item": [], "coverage": [], "n_tiles": []}
            for i, body in zip(id, text):
                for item, coverage, n in held.value.covered(body, threshold):
                    for c, v in zip(out, (i, item, coverage, n)):
                        out[c].append(v)
            return out

        return run

    schema = f"id {kinds[0]}, item {kinds[1]}, coverage double, n_tiles int"
    out = None
    for held in benchmark_blocks(benchmark, item_id, item_text, min_tile, block_tokens):
        found = batches(rows, step(held), schema)
        out = found if out is None else out.unionByName(found)
    return out.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_tile: int = 5,
    threshold: float = 0.5,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs`` that cover no item, with all their columns: a filter per block, no shuffle."""
    for held in benchmark_blocks(benchmark, item_id, item_text, min_tile, block_tokens):
        docs = docs.filter(~_leaked(held, threshold)(F.col(text_col)))
    return docs


def _leaked(held, threshold: float):
    @F.pandas_udf("boolean")
    def leaked(text: pd.Series) -> pd.Series:
        return pd.Series([any(True for _ in held.value.covered(t, threshold)) for t in text], dtype=bool)

    return leaked


def benchmark_blocks(benchmark: DataFrame, item_id: str, item_text: str, min_tile: int, block_tokens: int) -> list:
    """Broadcast blocks of about ``block_tokens`` tokens each, at least one."""
    spark = benchmark.sparkSession
    items = benchmark.filter(F.col(item_text).isNotNull() & F.col(item_id).isNotNull()).groupBy(F.col(item_id).alias("item"))
    items = items.agg(F.min(item_text).alias("text"))
    blocks = int((items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0) // block_tokens) + 1
    stored = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    stored = stored if blocks == 1 else materialize(stored, "items")
    made = []
    for k in range(blocks):
        listed = stored.filter(F.col("block") == k).select("item", "text").collect()  # about block_tokens tokens
        made.append(spark.sparkContext.broadcast(Block.of(sorted(map(tuple, listed)), min_tile)))
    return made


def document_verdicts(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (doc_id, contaminated, n_items, coverage, item_id), the last two of the item covered most."""
    best = F.max_by(F.struct("coverage", "item_id"), F.struct("coverage", F.col("item_id").cast("string"))).alias("best")
    by_doc = found.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), best)
    joined = docs.select(F.col(id_col).alias("doc_id")).join(by_doc.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"),
        F.col("best.item_id").alias("item_id"),
    )
