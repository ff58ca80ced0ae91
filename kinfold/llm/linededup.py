"""Line dedup with content-defined chunks of lines.

A text is cut into lines (at line feeds and, since whole paragraphs often stand on one line, after sentence ends). Each line is hashed
without outer white space; a rolling hash over the last two line hashes decides where a chunk ends, so a passage is cut at the same places
wherever it stands. Chunks, of two or more lines, that occur more than once in the corpus stay where they occur first
(smallest id, then smallest place) and are removed elsewhere, after their bytes are compared. A removed chunk takes along the lines beside it that are equal beside the
first occurrence too, so the ends of a copied passage, which share a chunk with other text, go as well.

Hashes and places alone are shuffled for all chunks. Repeated chunks that follow each other in both documents are joined to runs, and a run's text is
cut out of its document and compared with that of its first occurrence. Texts are shuffled twice, packed with zstandard.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinfold.llm.common import batches, give_back, mixed
from kinfold.session import materialize

LINE = re.compile(r"(?=[\s\S])[^\n.!?]*+(?:[.!?](?!\s)[^\n.!?]*+)*+(?:[.!?][^\S\n]*+\n?|\n|\Z)")
MIN_LINES = 2
MIN_CHARS = 40
SEED = 7  # of a line's hash
TEXTS = 200  # texts whose lines are hashed together
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # what str.strip takes away
BESIDE = 600  # characters looked at on either side of a repeated chunk
NEAR = 120  # characters looked at first for the last line of a text


def lines_of(text: str) -> list[tuple[int, int]]:
    """Start and end of each line, without gaps; a line keeps the white space after it."""
    ends = list(accumulate(map(len, LINE.findall(text))))
    return list(zip([0, *ends], ends))


def chunk_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, end and signed 64-bit hash of the content-defined chunks of all ``texts``.

    The rolling hash after a line is that of the line and the one before. A chunk ends where it is the smaller one of two neighbours, so any five
    lines in a row hold two ends at places that depend on these lines only. A chunk starts after the end before, and further
    back when it would have fewer than MIN_LINES lines or MIN_CHARS characters. Lines of all texts stand in one array, which keeps the
    numpy calls few; no chunk reaches over the end of a text.
    """
    found = [LINE.findall(text) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    lines = list(chain.from_iterable(found))
    bare = [line.strip() for line in lines]
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    kept = np.flatnonzero(np.fromiter(map(bool, bare), bool, len(bare)))
    bare = [line.encode("utf-8", "surrogatepass") for line in bare if line]
    body = b"\n".join(bare)  # a chunk is a part of it
    at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, bare), np.int64, len(bare)) + 1)))
    owner = np.repeat(np.arange(len(texts)), counts)[kept]
    hashes = np.array([xxhash.xxh64_intdigest(line, SEED) for line in bare], np.uint64)
    inside = owner[1:] == owner[:-1]
    rolling = np.full(len(kept) + 1, np.iinfo(np.uint64).max, np.uint64)
    pair = mixed(hashes[1:] + hashes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(1)
    rolling[1:-1][inside] = pair[inside]
    last = np.flatnonzero(inside & ((rolling[1:-1] < rolling[2:]) | (rolling[1:-1] <= rolling[:-2]))) + 1
    begins = np.concatenate(([0], ends))[kept]
    stops = ends[kept[last]]
    head = np.searchsorted(owner, owner[last])  # the first line of the chunk's text
    after = np.maximum(np.concatenate(([0], last[:-1] + 1))[: len(last)], head)
    # The nearest line that leaves MIN_CHARS; a chunk that has too few even from the first line on is none.
    far = np.searchsorted(begins, stops - MIN_CHARS, side="right") - 1
    first = np.minimum(np.minimum(after, last - MIN_LINES + 1), far)
    fits = first >= head
    first, last, stops = first[fits], last[fits], stops[fits]
    digests = [xxhash.xxh3_64_intdigest(body[f:e]) for f, e in zip(at[first].tolist(), (at[last + 1] - 1).tolist())]
    offset = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))[owner[last]]
    return owner[last], begins[first] - offset, stops - offset, np.array(digests, dtype=np.uint64).view(np.int64)


def chunks_of(text: str) -> tuple[list[int], list[int], list[int]]:
    """Starts, ends and hashes of the chunks of one text."""
    _, starts, stops, digests = chunk_table([text])
    return starts.tolist(), stops.tolist(), digests.tolist()


def bare_chunk(text: str) -> str:
    """The chunk's lines as they are compared: without outer white space, joined by line feeds."""
    return "\n".join(b for first, end in lines_of(text) if (b := text[first:end].strip()))


def same_start(left: str, right: str) -> int:
    """Number of characters that both texts begin with."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        mid = (low + high + 1) // 2
        if left[low:mid] == right[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def same_end(left: str, right: str) -> int:
    """Number of characters that both texts end with."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        mid = (low + high + 1) // 2
        if left[len(left) - mid : len(left) - low] == right[len(right) - mid : len(right) - low]:
            low = mid
        else:
            high = mid - 1
    return low


def last_start(text: str, end: int) -> int:
    """Where the last line of the first ``end`` characters begins.

    Where a line ends depends on what stands right before that place, so it shows from any place in the line on; the first line found from there may be cut.
    """
    window = NEAR
    while True:
        start = max(0, end - window)
        found = LINE.findall(text, start, end)
        if start == 0 or len(found) > 1:
            return end - len(found[-1]) if found else 0
        window *= 4


def equal_end(left: str, right: str) -> int:
    """Characters of ``left``'s last lines that are equal to the last lines of ``right``."""
    if left.rstrip()[-2:] != right.rstrip()[-2:] or left.rsplit(None, 1)[-1:] != right.rsplit(None, 1)[-1:]:
        return 0
    # Lines behind the first line end within the common end are equal; those before are compared.
    common = same_end(left, right)
    a, c = len(left) - common, len(right) - common
    step = LINE.match(left, a).end() - a if common else 0
    a, c = a + step, c + step
    while a and c:
        x, y = last_start(left, a), last_start(right, c)
        # A line at the edge of what was looked at may be cut and does not count.
        if x == 0 and len(left) >= BESIDE or y == 0 and len(right) >= BESIDE or left[x:a].strip() != right[y:c].strip():
            break
        a, c = x, y
    return len(left) - a


def equal_start(left: str, right: str, whole: bool = False) -> int:
    """Characters of ``left``'s first lines that are equal to the first lines of ``right``."""
    if left.lstrip()[:2] != right.lstrip()[:2] or left.split(None, 1)[:1] != right.split(None, 1)[:1]:
        return 0
    # Lines that end within the common start are equal; its last one may go on differently.
    common = same_start(left, right)
    taken = last_start(left, common)
    for mine, other in zip(LINE.finditer(left, taken), LINE.finditer(right, taken)):  # lines after the first unequal ones are not looked for
        # A line at the edge of what was looked at may be cut and does not count.
        if not whole and (mine.end() == len(left) >= BESIDE or other.end() == len(right) >= BESIDE):
            break
        if mine.group().strip() != other.group().strip():
            break
        taken = mine.end()
    return taken


def chunk_rows(keyed: DataFrame) -> DataFrame:
    """(id, content, start, end, hash) of every chunk, without text. Rows with one id and one text are one document."""
    kind = T.StructType([*keyed.select("id", "content").schema, *T._parse_datatype_string("start int, end int, hash bigint")])
    arrow = to_arrow_schema(kind)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                owner, start, end, digest = chunk_table(part.column("text").to_pylist())
                rows = pa.array(owner, pa.int64())
                own = [part.column(c).take(rows).cast(arrow.field(c).type) for c in ("id", "content")]
                made = [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(digest, pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, *made], schema=arrow)
        give_back()

    return keyed.mapInArrow(run, kind)


def runs_of(chunks: DataFrame) -> DataFrame:
    """(id, content, start, end, id1, content1, start1, end1): what repeats, and where it stands first.

    The chunks of a document that follow each other here and there are one run. A document's list is bounded by its own chunks.
    """
    order = F.struct(F.col("id").isNull().alias("late"), "id", "content", "start", "end")
    first = chunks.groupBy("hash").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = materialize(first, "first")  # so that the join below can split a hash with very many rows
    later = chunks.join(first, "hash").filter(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("content") == F.col("first.content")) & (F.col("start") == F.col("first.start")))
    )
    place = F.struct("start", "end", F.col("first.id").alias("id1"), F.col("first.content").alias("content1"), F.col("first.start").alias("start1"), F.col("first.end").alias("end1"))
    listed = later.groupBy("id", "content").agg(F.collect_list(place).alias("places"))
    kind = T.StructType([*listed.select("id", "content").schema, *listed.schema["places"].dataType.elementType])
    names = ["id", "content", "start", "end", "id1", "content1", "start1", "end1"]
    kind = T.StructType([T.StructField(c, kind[c].dataType) for c in names])
    arrow = to_arrow_schema(kind)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, stream):
            places = batch.column("places")
            owner = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            columns = dict(zip(names[2:], places.flatten().flatten()))
            at = {c: columns[c].to_numpy(zero_copy_only=False) for c in ("start", "end", "content1", "start1", "end1")}
            # Ids of any type as numbers; a null id, as a document's missing one, is a number of its own.
            at["id1"] = pc.dictionary_encode(columns["id1"], null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            order = np.lexsort((at["end"], at["start"], owner))
            owner, at = owner[order], {c: v[order] for c, v in at.items()}
            shift = at["start"] - at["start1"]
            joined = (at["start"][1:] <= at["end"][:-1]) & (shift[1:] == shift[:-1])
            for same in (owner, at["id1"], at["content1"]):
                joined &= same[1:] == same[:-1]
            opens = np.flatnonzero(np.concatenate(([True], ~joined)))  # starts and ends rise together within a document
            made = {"end": np.maximum.reduceat(at["end"], opens), "end1": np.maximum.reduceat(at["end1"], opens)}
            made |= {c: at[c][opens] for c in ("start", "start1", "content1")}
            made |= {c: batch.column(c).take(pa.array(owner[opens])) for c in ("id", "content")}
            made["id1"] = columns["id1"].take(pa.array(order[opens]))
            yield pa.RecordBatch.from_arrays([v.cast(f.type) if isinstance(v := made[f.name], pa.Array) else pa.array(v, f.type) for f in arrow], schema=arrow)

    return listed.mapInArrow(run, kind)


def packed(text: Column) -> Column:
    """The text as zstandard bytes; null stays null."""

    @F.arrow_udf(T.BinaryType())
    def pack(bodies: pa.Array) -> pa.Array:
        tool = zstandard.ZstdCompressor(level=1)
        return pa.array([None if b is None else tool.compress(b) for b in bodies.cast(pa.binary()).to_pylist()], pa.binary())

    return pack(text)


@lru_cache(maxsize=1)
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def unpacked(body: bytes) -> str:
    return _unpacker().decompress(body).decode("utf-8", "surrogatepass")


def slices(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, content, start, end, body, left, right) of every span (id, content, start, end): its text and what stands beside it."""
    listed = spans.groupBy(F.col("id").alias("i"), F.col("content").alias("c")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = keyed.select("id", "content", packed(F.col("text")).alias("text"))
    held = texts.join(listed, F.col("id").eqNullSafe(F.col("i")) & (F.col("content") == F.col("c"))).select(
        "id", "content", "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")
    )

    def step(id, content, text, starts, ends):
        out = {c: [] for c in ("id", "content", "start", "end", "body", "left", "right")}
        for i, c, body, begins, stops in zip(id, content, text, starts, ends):
            body = unpacked(body)
            out["id"] += [i] * len(begins)
            out["content"] += [c] * len(begins)
            out["start"] += begins
            out["end"] += stops
            out["body"] += [body[a:b] for a, b in zip(begins, stops)]
            out["left"] += [body[max(0, a - BESIDE) : a] for a in begins]
            out["right"] += [body[b : b + BESIDE] for b in stops]
        return out

    kind = keyed.schema["id"].dataType.simpleString()
    return batches(held, step, f"id {kind}, content bigint, start int, end int, body string, left string, right string")


def _edge(text: Column, at: int) -> Column:
    """The last (-1) or first (1) word of a text without outer white space, as far as 64 characters show it. Equal lines have equal ones."""
    shown = F.substring(text, -64 if at < 0 else 1, 64)
    return F.substring_index(F.translate(shown, BLANKS, " " * len(BLANKS)), " ", at)


def removals(runs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, content, start, end): the parts of the runs that go, after their bytes are compared with the first occurrence.

    A run whose lines are not those of the first occurrence goes only as far as the lines are equal from its start. ``texts`` has the span of each run and of
    each first occurrence, one row for each span.
    """
    names = ["id", "content", "start", "end"]
    mine = texts.select(*[F.col(c).alias(f"m_{c}") for c in texts.columns])
    other = texts.select(*[F.col(c).alias(f"o_{c}") for c in texts.columns])

    def same(side: str, suffix: str) -> Column:
        pairs = [F.col(f"{c}{suffix}").eqNullSafe(F.col(f"{side}_{c}")) for c in names]
        return pairs[0] & pairs[1] & pairs[2] & pairs[3]

    met = runs.join(other, same("o", "1")).drop(*[f"o_{c}" for c in names]).join(mine, same("m", ""))
    # Equal bodies, and neighbours that cannot be equal, need not go to Python.
    differs = F.col("m_body") != F.col("o_body")
    ends_alike = _edge(F.rtrim("m_left", F.lit(BLANKS)), -1) == _edge(F.rtrim("o_left", F.lit(BLANKS)), -1)
    starts_alike = _edge(F.ltrim("m_right", F.lit(BLANKS)), 1) == _edge(F.ltrim("o_right", F.lit(BLANKS)), 1)
    needed = {"body": differs, "left": ends_alike, "right": starts_alike}
    sides = [F.when(test, F.col(f"{side}_{c}")).alias(f"{side}_{c}") for side in "mo" for c, test in needed.items()]
    met = met.select(*names, *sides)

    def step(id, content, start, end, m_body, m_left, m_right, o_body, o_left, o_right):
        spans = [
            (a, b) if texts[0] is None and texts[1] is None and texts[2] is None else gone(a, b, *[t or "" for t in texts])
            for a, b, *texts in zip(start, end, m_body, m_left, m_right, o_body, o_left, o_right)
        ]
        return {"id": id, "content": content, "start": [a for a, _ in spans], "end": [b for _, b in spans]}

    kind = runs.schema["id"].dataType.simpleString()
    return batches(met, step, f"id {kind}, content bigint, start int, end int").filter("end > start")


def gone(start: int, end: int, body: str, left: str, right: str, first_body: str, first_left: str, first_right: str) -> tuple[int, int]:
    """The span that goes: the run and the equal lines beside it, or the equal lines at the start of a run that is not equal."""
    if body == first_body or bare_chunk(body) == bare_chunk(first_body):
        return start - equal_end(left, first_left), end + equal_start(right, first_right)
    return start, start + equal_start(body, first_body, whole=True)


def without(text: str, starts, ends) -> str:
    """``text`` without the spans, which may overlap, and without white space that is left at its end."""
    kept, at = [], 0
    for start, end in sorted(zip(starts, ends)):
        if start > at:
            kept.append(text[at:start])
        at = max(at, end)
    return "".join([*kept, text[at:]]).rstrip()


@F.arrow_udf(T.StringType())
def cut_out(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    whole = (None if t is None else unpacked(t) for t in text.to_pylist())
    rows = zip(whole, starts.to_pylist(), ends.to_pylist())
    return pa.array((t if t is None or s is None else without(t, s, e) for t, s, e in rows), pa.string())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks taken out of its text, all other columns as they were, plus ``removed_chars``.

    Every row stays, with an empty text if all of it stood elsewhere before. Null texts stay null and empty ones empty. Rows with the
    same id and the same text are one document and are treated alike; null ids order last. A column of ``docs``
    named removed_chars is replaced; names that begin with _dedup are reserved.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("content"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    runs = materialize(runs_of(materialize(chunk_rows(keyed), "chunks")), "runs")
    spans = runs.select("id", "content", "start", "end").unionByName(runs.select(*[F.col(f"{c}1").alias(c) for c in ("id", "content", "start", "end")]))
    going = removals(runs, materialize(slices(keyed, spans), "slices"))
    listed = going.groupBy(F.col("id").alias("_dedup_id"), F.col("content").alias("_dedup_content")).agg(
        F.collect_list(F.struct("start", "end")).alias("_dedup_spans")
    )
    others = [c for c in docs.columns if c not in (text_col, "removed_chars")]
    marked = docs.select(
        *others, packed(F.col(text_col)).alias("_dedup_text"), F.xxhash64(text_col).alias("_dedup_hash"), F.length(text_col).alias("_dedup_length")
    )
    same = F.col(id_col).eqNullSafe(F.col("_dedup_id")) & (F.col("_dedup_hash") == F.col("_dedup_content"))
    joined = marked.join(materialize(listed, "spans"), same, "left")
    kept = joined.withColumn("_dedup_kept", cut_out("_dedup_text", F.col("_dedup_spans.start"), F.col("_dedup_spans.end")))
    columns = [F.col("_dedup_kept").alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "removed_chars"]
    return kept.select(*columns, (F.col("_dedup_length") - F.length("_dedup_kept")).alias("removed_chars"))
