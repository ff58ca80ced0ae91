"""Best-fit packing under conflicts: sequences of at most ``capacity`` words, one document per source and per duplicate cluster in each.

Bins are kept in order of what room they have left. A piece goes to the bin with the least sufficient room; when that bin's source or cluster
bitmap already has the piece's bit, the search goes on to the next larger room, until the tightest compatible bin is found
or a new one is opened. Pieces are placed longest first.

Only (id, length, source, cluster) is shuffled. Rows are dealt by a hash of the row into shards of about ``shard_rows`` rows; each is packed on its
own, so a task's memory and the length of its searches are bounded whatever share of the rows a source or cluster has. A shard leaves a few bins
part-filled, which at thousands of rows a shard is a small loss.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CAPACITY = 2048
SHARD_ROWS = 4000


def word_count(text: str) -> Column:
    """Words of the text; null counts as empty."""
    bare = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\t-\r ]+", " "))
    return F.when(bare == "", F.lit(0)).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1)


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin number of each piece, placed in the order given."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(clusters))}
    open_bins: list[tuple[int, int]] = []  # (room left, bin), ascending
    held: list[tuple[int, int]] = []  # source and cluster bitmaps by bin
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = source_bit[source], cluster_bit[cluster]
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (held[open_bins[at][1]][0] & s or held[open_bins[at][1]][1] & c):
            at += 1
        if at < len(open_bins):
            room, chosen = open_bins.pop(at)
        else:
            room, chosen = capacity, len(held)
            held.append((0, 0))
        held[chosen] = (held[chosen][0] | s, held[chosen][1] | c)
        if room > size:
            insort(open_bins, (room - size, chosen))
        placed.append(chosen)
    return placed


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(doc_id, piece, first_word, n_words, source, bin_id, bin_words): one row per piece of each row of ``docs``.

    A document of more than ``capacity`` words is cut into pieces; whole pieces fill a bin of their own. ``cluster`` says which rows are
    duplicates of each other, by default those of equal text without regard to case and white space. Null and empty texts have one piece of
    no words. A null source is a source; null texts form one cluster with the empty ones. Repeated rows are pieces of one cluster and so land in different
    bins. An empty table gives no rows. Other columns are not read.
    """
    words = word_count(text_col)
    if cluster is None:
        cluster = F.xxhash64(F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(text_col), F.lit("")))), r"[\t-\r ]+", " "))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), words.cast("bigint").alias("words"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster")
    )
    last = F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0))
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("piece") * capacity
    cut = cut.withColumn("first_word", first).withColumn("n_words", F.least(F.col("words") - first, F.lit(capacity).cast("bigint")))
    shards = max(1, -(-docs.count() // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_words", "order"], ascending=[False, True], kind="stable").reset_index(drop=True)
        sources = part["source"].where(part["source"].notna(), None).tolist()
        bins = best_fit(part["n_words"].tolist(), sources, part["cluster"].tolist(), capacity)
        part["bin_id"] = part["shard"].astype(str) + "-" + pd.Series(bins, dtype=str)
        part["bin_words"] = part.groupby("bin_id")["n_words"].transform("sum")
        return part[["doc_id", "piece", "first_word", "n_words", "source", "bin_id", "bin_words"]]

    narrow = cut.select(
        "doc_id", "piece", "first_word", "n_words", "source", "cluster", shard.alias("shard"), F.xxhash64("doc_id", "piece").alias("order")
    )
    return narrow.groupBy("shard").applyInPandas(
        place, f"doc_id {kind}, piece bigint, first_word bigint, n_words bigint, source string, bin_id string, bin_words bigint"
    )
