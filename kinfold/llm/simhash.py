"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The binary Golay code [23, 12, 7] is perfect:
every 23-bit word has exactly one codeword within distance 3. A word gives the index of that codeword as key
and, when it lies at distance 3, also those of the five codewords at distance 4: one or six keys. Two words that
differ in at most two bits always share one of these keys, since in the coset of a word at distance 3 the leader and
the five weight-4 words part the 23 positions among themselves.

Two fingerprints that differ in at most two bits differ in at most two of the three segments, so one segment is equal and
the segment after it differs in at most two bits. The join key is therefore (equal segment, one Golay key of the next):
up to 18 keys of up to 35 bits, and no pair within two bits is lost. Pairs that share a key are verified by their differing bits.

``one_of_each`` also takes texts for copies whose sets of five-word shingles have a Jaccard similarity of 0.8 or more. Such texts often differ in
five to fifteen bits of a SimHash, out of reach of any key that stays selective, so it adds min-wise bands over those shingles, each
candidate being checked on its whole shingle sets. Crowded bands, as of texts with a common passage, are cut further by an exact prefix filter.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import ceil

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinfold.llm.common import batches, mixed
from kinfold.operators.linking import components
from kinfold.operators.skew import hot_keys, salted_join
from kinfold.session import materialize

GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the binary Golay code
BITS = 23
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit and width of each segment
BLOCK = 1 << 14  # shingles whose bits are counted at once
BUCKET = 64  # fingerprints of one join key that are compared with each other; more are verified by `met_at_words`
SIMILAR = 0.8  # Jaccard similarity of shingle sets from which on two texts are copies
WIDE = 5  # words in a shingle of these sets
BANDS, ROWS = 32, 4  # a pair at 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8
LEADERS = 64  # slots for leaders in one band in one round, at most, unless ``ROUND`` allows more
ROUND = 1 << 24  # rows of (band, leader, node) in one round, about
CROWDED = 16  # texts of a band outside its largest part, up to which all are compared; bands of more are cut by `parted`
ORDER = 16  # texts of a crowded band that tell the order of its shingles
FACTORS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _syndrome(word: int) -> int:
    for bit in range(BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each byte at each of three places, error patterns to the near codewords by syndrome).

    A row of the second table has the coset leader first; the five weight-4 patterns follow when the leader has
    weight 3, and the leader is repeated otherwise.
    """
    bytewise = np.array([[_syndrome(b << 8 * place & (1 << BITS) - 1) for b in range(256)] for place in range(3)])
    near: dict[int, list[int]] = {}
    single = [1 << i for i in range(BITS)]
    for weight in range(5):
        for places in combinations(single, weight):
            found = near.setdefault(_syndrome(sum(places)), [])
            if weight < 4 or found[0].bit_count() == 3:
                found.append(sum(places))
    rows = [near[s] if len(near[s]) == 6 else near[s][:1] * 6 for s in range(1 << 11)]
    return bytewise, np.array(rows, dtype=np.int64)


def golay_keys(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The six (with repeats) codeword indices near each 23-bit word."""
    bytewise, near = tables
    low, mid, high = words & 255, words >> 8 & 255, words >> 16
    syndrome = bytewise[0][low] ^ bytewise[1][mid] ^ bytewise[2][high]
    return (words[:, None] ^ near[syndrome]) >> 11  # the code is systematic in its upper 12 bits


def join_keys(fingerprints: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """18 join keys (with repeats) for each unsigned fingerprint."""
    parts = [(fingerprints >> np.uint64(a)).astype(np.int64) & (1 << n) - 1 for a, n in SEGMENTS]
    keys = []
    for i in range(3):
        index = golay_keys(parts[(i + 1) % 3], tables)
        keys.append((i << 35) | (parts[i][:, None] << 12) | index)
    return np.concatenate(keys, axis=1)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits over the XXH64 (seed 42) of all word shingles, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        hashes = [
            xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(start, min(n, start + BLOCK))
        ]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")
    return value - (1 << 64) if value >> 63 else value


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of the five-word shingles; of the whole sequence if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64)
    n = max(1, len(words) - WIDE + 1)
    joined = np.full(n, len(words) if n == 1 else WIDE, np.uint64)
    for k in range(min(WIDE, len(words))):
        joined = mixed(joined ^ hashes[k : k + n]) + np.uint64(k)
    return np.unique(joined)


def band_keys(shingles: np.ndarray) -> list[int]:
    """One signed 64-bit key for each band of min-wise hashes; none for a text without words."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK >> 3):
        part = shingles[start : start + (BLOCK >> 3)]
        least = np.minimum(least, (part[:, None] * FACTORS).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = mixed(keys ^ row) + np.uint64(1)
    return keys.view(np.int64).tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bands: bool = False) -> DataFrame:
    """(doc_id, content, fp): the SimHash of every whole text, and a hash of the text that tells rows of one id apart.

    With ``bands`` also the min-wise band keys over five-word shingles.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("content"), F.col(text_col).alias("text"))

    def step(id, content, text):
        made = {"id": id, "content": content, "fp": [fingerprint(t, shingle) for t in text]}
        return made | ({"bands": [band_keys(shingle_set(t)) for t in text]} if bands else {})

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, content bigint, fp bigint" + (", bands array<bigint>" if bands else "")
    return batches(rows, step, schema).withColumnRenamed("id", "doc_id")


def links(distinct: DataFrame) -> DataFrame:
    """(lo, hi): links that join all fingerprints of ``distinct`` (fp, one row each) within two bits of each other.

    Fingerprints are joined on their Golay keys and the pairs that share one are verified by their differing bits, within the row of the key. That holds for
    keys of up to ``BUCKET`` fingerprints, nearly all: a key has 35 bits. The fingerprints of fuller keys are verified without pairs
    by ``met_at_words``; so every pair within two bits is found by one of the two, whatever the sizes.
    """
    tables = golay_tables()

    def step(fp):
        keys = join_keys(np.array(fp, dtype=np.int64).view(np.uint64), tables)
        n = keys.shape[1]
        keys = np.sort(keys, axis=1)
        first = np.ones_like(keys, dtype=bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        return {"key": keys[first], "fp": np.repeat(np.array(fp, dtype=np.int64), n)[first.ravel()]}

    keyed = materialize(batches(distinct, step, "key bigint, fp bigint"), "golay")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = materialize(keyed.join(shared, "key"), "golay-joined")
    held = joined.filter(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list("fp").alias("all"))
    near = F.filter("all", lambda hi: (hi > F.col("lo")) & (F.bit_count(F.col("lo").bitwiseXOR(hi)) <= 2))
    verified = held.select("all", F.explode("all").alias("lo")).select("lo", F.explode(near).alias("hi"))
    crowded = joined.filter(F.col("n") > BUCKET).select("fp").distinct()
    return verified.unionByName(met_at_words(crowded)).distinct()


def met_at_words(found: DataFrame) -> DataFrame:
    """(lo, hi): the same for fingerprints too many to compare in pairs; linear in their number.

    Two fingerprints differ in at most two bits exactly when some word is within one bit of
    both. Each is sent to the 65 words within one bit, and those that meet at a word are linked to the
    smallest of them. At most 65 can meet at one word, however large the group of copies is.
    """
    bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    words = F.array_union(F.array(F.col("fp")), F.transform(bit, lambda b: F.col("fp").bitwiseXOR(b)))
    met = found.select("fp", F.explode(words).alias("word")).groupBy("word").agg(F.collect_list("fp").alias("all"))
    return (
        met.filter(F.size("all") > 1)
        .select(F.array_min("all").alias("lo"), F.explode("all").alias("hi"))
        .filter("hi > lo")
    )


def grouped(marked: DataFrame) -> DataFrame:
    """Stored rows of ``fingerprints`` with root, the smallest fingerprint of the component, and component_id, its smallest doc_id."""
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp"))).select(F.col("record_seq").alias("fp"), F.col("entity_id").alias("root"))
    placed = materialize(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(placed.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def compared(members: DataFrame, leaders: int) -> DataFrame:
    """(key, leader, node): leaders of each band beside those of its nodes that are in another part and not too far in size to be similar. ``members`` has key, node, part, degree and size.

    Each of ``leaders`` slots of a band gives the node with the most links of the last round, which is where a star of copies has its centre, and one
    of the smallest part, so that a band of one large part and a few others ends with the others.
    """
    slot = F.pmod(F.xxhash64("node", F.lit(leaders)), F.lit(leaders))
    top = F.max_by(F.struct(F.col("node").alias("leader"), F.col("size").alias("leader_size")), F.struct("degree", -F.col("node"))).alias("top")
    by_slot = members.groupBy("key", "part", slot.alias("slot")).agg(top, F.max("degree").alias("degree"), F.count(F.lit(1)).alias("n"))
    by_slot = materialize(by_slot.select("key", "part", "slot", "top.*", "degree", "n"), "slots")
    parts = by_slot.groupBy("key", "part").agg(F.sum("n").alias("mass"))
    one = F.struct("leader", F.col("part").alias("leader_part"), "leader_size")
    picked = (
        by_slot.join(parts, ["key", "part"])
        .groupBy("key", "slot")
        .agg(F.max_by(one, F.struct("degree", -F.col("leader"))).alias("linked"), F.min_by(one, F.struct("mass", "leader")).alias("small"))
    )
    beside = materialize(picked.select("key", F.explode(F.array_distinct(F.array("linked", "small"))).alias("one")).select("key", "one.*"), "leaders")
    sizes = by_slot.groupBy("key").agg(F.sum("n").alias("n"))
    met = salted_join(members.select("key", "node", "part", "size"), beside, ["key"], hot_keys(sizes, ["key"]))
    alike = F.least("size", "leader_size") >= SIMILAR * F.greatest("size", "leader_size") - 1e-6
    return met.filter((F.col("leader") == F.col("node")) | (F.col("part") != F.col("leader_part")) & alike).select("key", "leader", "node")


def common_shingles(some: list[list[int]]) -> list[int]:
    """The shingles that several of the sets hold, those of the fewest first."""
    values, times = np.unique(np.concatenate([np.array(s, np.int64) for s in some]), return_counts=True)
    order = np.lexsort((values, times))
    return values[order][times[order] > 1].tolist()


def prefix(shingles: list[int], common: list[int]) -> list[int]:
    """The first |set| - 0.8 |set| + 1 of the shingles, in an order that has those of ``common`` last, as they stand there.

    Two sets at a similarity of 0.8 or more have 0.8 of either in common, so whatever the order is, the first common one is in both prefixes.
    """
    own, known = np.array(shingles, np.int64), np.array(common, np.int64)
    rank = np.zeros(len(own), np.int64)
    if len(known):
        by_value = np.argsort(known)
        at = by_value[np.minimum(np.searchsorted(known, own, sorter=by_value), len(known) - 1)]
        rank = np.where(known[at] == own, at + 1, 0)
    return own[np.lexsort((own, rank))][: len(own) - ceil(SIMILAR * len(own) - 1e-6) + 1].tolist()


def parted(state: DataFrame, sets: DataFrame) -> DataFrame:
    """``state`` (key, node, part, degree, size) with crowded bands cut into smaller groups; any two similar texts of a band that are in two parts share a group.

    An exact prefix filter (``prefix``): the texts of a band that meet at a shingle of their prefixes are a group. The order of the shingles, which decides on speed alone, has
    last what ``ORDER`` texts of the band have in common, as a frequent passage, so dissimilar texts hardly meet. Groups of the same texts are one;
    a band whose groups have more than half of its pairs stays as it is.
    """
    masses = state.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    crowded = materialize(masses.filter(F.col("n") - F.col("most") > CROWDED).select("key", "n"), "crowded")
    if crowded.isEmpty():
        return state
    inside = materialize(salted_join(state, crowded.select("key"), ["key"], hot_keys(crowded, ["key"])).select(*state.columns), "inside")
    some = inside.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(ORDER)).alias("slot")).agg(F.min("node").alias("node"))
    some = some.join(sets, "node").groupBy("key").agg(F.collect_list("shingles").alias("some"))  # of ORDER texts at most
    common = batches(some, lambda key, some: {"key": key, "common": [common_shingles(s) for s in some]}, "key bigint, common array<bigint>")
    common = materialize(common, "common")

    def step(key, node, part, shingles, common):
        found = [prefix(*both) for both in zip(shingles, common)]
        times = [len(f) for f in found]
        made = {c: np.repeat(np.array(v, np.int64), times) for c, v in (("key", key), ("node", node), ("part", part))}
        return made | {"shingle": [x for f in found for x in f]}

    met = salted_join(inside.select("key", "node", "part"), common, ["key"], hot_keys(crowded, ["key"])).join(sets, "node")
    sent = materialize(batches(met.select("key", "node", "part", "shingles", "common"), step, "key bigint, node bigint, part bigint, shingle bigint"), "prefixes")
    groups = sent.groupBy("key", "shingle").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("part").alias("a"),
        F.max("part").alias("b"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    groups = materialize(groups.filter("a <> b").groupBy("key", "n", "x", "y").agg(F.min("shingle").alias("shingle")), "groups")
    pairs = groups.groupBy("key").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    fewer = crowded.join(pairs, "key", "left").filter(2 * F.coalesce("pairs", F.lit(0.0)) <= F.col("n").cast("double") * F.col("n")).select("key")
    fewer = materialize(fewer, "fewer")
    groups = groups.join(fewer, "key").select("key", "shingle", "n")
    cut = salted_join(sent.select("key", "shingle", "node"), groups.drop("n"), ["key", "shingle"], hot_keys(groups, ["key", "shingle"]))
    cut = cut.select(F.xxhash64("key", "shingle").alias("key"), "node").join(inside.select("node", "part", "degree", "size").distinct(), "node")
    whole = state.join(fewer, "key", "left_anti")
    return materialize(whole.select(*state.columns).unionByName(cut.select(*state.columns)), "parted")


def similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(leader, node) of ``pairs`` whose shingle sets, (node, shingles), have a Jaccard similarity of at least 0.8."""
    weights = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    held = pairs.join(sets, "node")
    first = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("other"))
    met = salted_join(held, first, ["leader"], hot_keys(weights, ["leader"]))
    both = F.size(F.array_intersect("shingles", "other"))
    return met.filter(both >= SIMILAR * (F.size("shingles") + F.size("other") - both)).select("leader", "node")


def similar_links(nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(lo, hi): links between similar texts. ``nodes`` is a stored frame with node and bands; ``texts_of`` gives (node, text) of some of its rows.

    In each band the texts are compared with a few leaders. A leader that was compared leaves the band, all others stay in it, linked or not, and are
    compared with the next leaders, twice as many, but for pairs that links already join into one part. A band of many parts is cut into groups that dissimilar texts
    hardly share (``parted``). A band ends when what is left of it is one part. So of any two similar texts that share a band, either the pair was compared or both are in one part.
    """
    members = nodes.select("node", F.explode(F.array_distinct("bands")).alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    members = materialize(members.join(shared, "key"), "bands")
    involved = materialize(nodes.join(members.select("node").distinct(), "node", "left_semi").drop("bands"), "involved")
    sets = materialize(
        batches(
            texts_of(involved).dropDuplicates(["node"]),
            lambda node, text: {"node": node, "shingles": [shingle_set(t).view(np.int64) for t in text]},
            "node bigint, shingles array<bigint>",
        ),
        "shingles",
    )
    members = materialize(members.join(sets.select("node", F.size("shingles").alias("size")), "node").select("key", "node", "size"), "bands")
    joined, degrees, leaders = None, None, 1
    while rows := members.count():
        if joined is None:
            state = members.withColumn("part", F.col("node")).withColumn("degree", F.lit(0).cast("bigint"))
        else:
            moved = joined.select(F.col("record_seq").alias("node"), F.col("entity_id").alias("part"))
            state = members.join(moved, "node", "left").join(degrees, "node", "left")
            state = state.select("key", "node", F.coalesce("part", "node").alias("part"), F.coalesce("degree", F.lit(0)).alias("degree"), "size")
            several = state.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a <> b").select("key")
            state = parted(materialize(state.join(several, "key", "left_semi"), "parts"), sets)
        leaders = max(1, min(leaders, max(LEADERS, ROUND // rows)))
        beside = materialize(compared(state, leaders), "beside")
        pairs = materialize(beside.filter("leader <> node").select("leader", "node").distinct(), "pairs")
        ends = similar_pairs(pairs, sets)
        new = materialize(ends.select(F.least("leader", "node").alias("lo"), F.greatest("leader", "node").alias("hi")).distinct(), "similar")
        edges = new if joined is None else new.unionByName(joined.select(F.col("entity_id").alias("lo"), F.col("record_seq").alias("hi")))
        joined = components(edges)
        degrees = new.select(F.explode(F.array("lo", "hi")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        done = beside.filter("leader = node").select("key", "node").distinct()
        members = materialize(state.select("key", "node", "size").join(done, ["key", "node"], "left_anti"), "bands")
        leaders *= 2
    if joined is None:
        return nodes.select(F.col("node").alias("lo"), F.col("node").alias("hi")).limit(0)
    return joined.select(F.col("entity_id").alias("lo"), F.col("record_seq").alias("hi"))


def fingerprint_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints that differ in at most two bits are linked; a component's id is the smallest doc_id in it. Texts with
    one fingerprint form one node, so a third of all rows being copies costs one node. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows stay; a null doc_id is carried, and a component with
    null ids only has a null id. Other columns of ``docs`` are not read.
    """
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return grouped(marked).select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id; all columns stay as they are.

    Texts are linked when their fingerprints differ in at most two bits or their sets of five-word shingles are similar. Null and empty texts
    are one group. A null id comes after all others. Of several rows with the smallest id one stays. Columns whose names begin with _kept are reserved.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle, bands=True), "fingerprints")
    counted = grouped(marked).groupBy("root", "doc_id", "content").agg(F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "content")
    first = counted.groupBy("root").agg(F.min_by(F.struct("doc_id", "content", "n", "bands"), order).alias("one"))
    ones = materialize(first.select(F.col("root").alias("node"), "one.*"), "ones")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_content"), F.col(text_col).alias("text"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        met = rows.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_content") == F.col("content")))
        return met.select("node", "text")

    moved = components(similar_links(ones, texts_of)).select(F.col("record_seq").alias("node"), F.col("entity_id").alias("group"))
    last = ones.join(moved, "node", "left").withColumn("group", F.coalesce("group", "node"))
    best = last.groupBy("group").agg(F.min_by(F.struct("doc_id", "content", "n"), order).alias("one"))
    kept = materialize(
        best.select(F.col("one.doc_id").alias("_kept_id"), F.col("one.content").alias("_kept_text"), F.col("one.n").alias("_kept_rows")), "kept"
    )
    same = F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.xxhash64(text_col) == F.col("_kept_text"))
    rows = docs.join(kept, same)
    single = rows.filter("_kept_rows = 1")
    if not kept.filter("_kept_rows > 1").isEmpty():
        single = single.unionByName(rows.filter("_kept_rows > 1").dropDuplicates(["_kept_id", "_kept_text"]))
    return single.select(*docs.columns)
