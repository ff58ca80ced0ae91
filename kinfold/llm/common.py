"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

SENT = 4 << 20  # bytes of a batch that goes back to the JVM, about
PIECE = 1 << 20  # long texts are hashed in pieces of about this many bytes, so that memory stays bounded
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD_BYTE = np.array([(c >= 128) or chr(c).isalnum() or c == 95 for c in range(256)])


def remainder(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % mod


def batches(frame: DataFrame, step: Callable[..., dict], schema: str | T.StructType) -> DataFrame:
    """``frame`` through ``step``, which gets each Arrow batch's columns as lists and returns named lists.

    Batches are streamed, so a task holds one of them at a time; what ``step`` returns goes on in parts of about ``SENT`` bytes.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)
    names = frame.columns

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                made = step(**{c: part.column(i).to_pylist() for i, c in enumerate(names)})
                yield from parts(pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow))
        give_back()

    return frame.mapInArrow(run, kind)


def parts(batch: pa.RecordBatch, size: int = SENT) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``size`` bytes, at its mean row."""
    rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers stay alive between tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``raw`` in pieces that end at white space, each about ``size`` long unless a word is longer."""
    start = 0
    while len(raw) - start > size:
        cut = raw.find(b" ", start + size)
        if cut < 0:
            break
        yield raw[start:cut]
        start = cut + 1
    yield raw[start:]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for at, base in enumerate((BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each run of word bytes: differences of one running polynomial, shifted to the start."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = power_tables(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=running[1:])
    return mixed((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of all words of the lower-cased text, in order, repeats included. Null and empty: none."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    parts = [_hashes(p) for p in pieces(raw) if p]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def share(wanted: int, rows: int) -> float:
    """The share of ``rows`` that leaves about ``wanted`` of them."""
    return 1.0 if rows <= wanted else wanted / rows


def hash_share(key: str, part: float, seed: str) -> Column:
    """True for about ``part`` of the keys, the same ones in every run."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    return bucket < F.lit(int(part * (1 << 30)))


def meet(many: DataFrame, few: DataFrame, block: str, blocks: int, groups: int) -> DataFrame:
    """Every row of ``many`` beside every row of ``few``, whose ``block`` counts from 0 to ``blocks`` - 1.

    An equality join on (block, group): rows of ``many`` fall into ``groups`` by a hash, so no key has more than its share of them, and both sides
    are repeated for the other one's keys. Spark broadcasts ``few`` where its size statistics allow.
    """
    spread = F.pmod(F.xxhash64(*many.columns), F.lit(groups)).cast("int")
    left = many.withColumn("_group", spread).withColumn(block, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = few.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return left.join(right, [block, "_group"]).drop("_group")
