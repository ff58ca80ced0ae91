import random

import numpy as np
import pytest
import xxhash

from kinfold.llm import simhash


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """doc_id lists by brute force over all pairs of fingerprints."""
    prints = sorted({f for _, f in rows})
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    low = {}
    for d, f in rows:
        low[find(f)] = min([x for x in (d, low.get(find(f))) if x is not None], default=None)
    return sorted(((d, f"{f:016x}", low[find(f)]) for d, f in rows), key=repr)


def test_words_within_two_bits_share_a_golay_key():
    tables, rng = simhash.golay_tables(), random.Random(3)
    assert len(set(tables[1][:, 0].tolist())) == 2048
    for _ in range(4000):
        a = rng.getrandbits(23)
        b = a
        for bit in rng.sample(range(23), rng.randrange(3)):
            b ^= 1 << bit
        x, y = simhash.golay_keys(np.array([a, b]), tables)
        assert set(x) & set(y)


def test_fingerprints_within_two_bits_share_a_join_key():
    tables, rng = simhash.golay_tables(), random.Random(4)
    for _ in range(4000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(3)):
            b ^= 1 << bit
        x, y = simhash.join_keys(np.array([a, b], dtype=np.uint64), tables)
        assert set(x) & set(y)


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    for i in range(120):
        if i % 3 and texts:
            text = rng.choice(texts).split()
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text)
        else:
            text = " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 80, 300])))
        texts.append(text)
        rows.append((i, text.upper() if i % 7 == 0 else text))
    rows += [(500, ""), (501, None), (499, " \t")]
    got = simhash.fingerprint_components(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert sorted(map(tuple, got), key=repr) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_query_matches_brute_force(spark, documents):
    from kinfold.llm.queries import QUERIES

    got = QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()])
    assert sorted(map(tuple, got), key=repr) == want


def test_a_chain_of_links_is_one_component(spark):
    prints = [0b111 << i for i in range(0, 30, 1)]
    found = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    pairs = {(r.lo, r.hi) for r in simhash.links(found).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    assert len(pairs) >= len(prints) - 1


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_are_the_near_pairs(spark, monkeypatch, bucket):
    """Clusters around random centres, one of them in a crowded key; with small buckets the fuller keys take the other way."""
    rng = random.Random(9)
    prints = set()
    for size in (1, 2, 5, 12, 40):
        for _ in range(3):
            centre = rng.getrandbits(64)
            prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(size)}
    centre = rng.getrandbits(64) & ~(0x3FFFF << 46)
    prints |= {centre | rng.getrandbits(18) << 46 for _ in range(150)}  # two segments equal: one key holds them all
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    pairs = {(r.lo, r.hi) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    assert pairs <= near

    def parts(edges):
        root = {p: p for p in signed}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in edges:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {p: find(p) for p in signed}

    assert parts(pairs) == parts(near) and len(near) > 200


def test_edges(edge_docs, no_docs):
    got = simhash.fingerprint_components(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].fingerprint == by_id[3].fingerprint == "0" * 16 and by_id[4].component_id == 2
    assert simhash.fingerprint_components(no_docs).collect() == []


def test_one_of_each(edge_docs, no_docs):
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 5, 6, 7, 8]
    assert [r.text for r in rows if r.doc_id is None] == ["der die das und nicht ein"]
    assert simhash.one_of_each(no_docs).collect() == []


@pytest.mark.parametrize("words", [1, 2, 3, 4, 70_000])
def test_fingerprint_lengths(words):
    text = " ".join(f"W{i}" for i in range(words))
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def wide_similarity(a, b):
    def shingles(t):
        words = t.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def edited(rng, words, vocabulary, edits):
    """``words`` with ``edits`` of them replaced, at least six words apart."""
    out, places = list(words), rng.sample(range(0, len(words), 6), edits)
    for at in places:
        out[at] = rng.choice(vocabulary)
    return out


def test_similar_texts_leave_one_document(spark):
    """Pairs around the limit: those at 0.8 or more lose the larger id, the others stay."""
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(3000)]
    rows, want = [], set()
    for pair in range(60):
        first = rng.choices(vocabulary, k=rng.choice([90, 200, 400]))
        second = edited(rng, first, vocabulary, 1 + len(first) * (pair % 6) // 120)
        rows += [(2 * pair, " ".join(first)), (2 * pair + 1, " ".join(second).upper())]
        want |= {2 * pair} if wide_similarity(rows[-2][1], rows[-1][1]) >= 0.8 else {2 * pair, 2 * pair + 1}
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert 60 < len(want) < 120
    assert kept == want


def test_a_large_group_of_similar_texts(spark):
    """Copies of one text with an edit each, and texts that share most bands with them without being similar."""
    rng = random.Random(10)
    vocabulary = [f"word{i}" for i in range(3000)]
    first = rng.choices(vocabulary, k=200)
    rows = [(n, " ".join(edited(rng, first, vocabulary, 2))) for n in range(150)]
    rows += [(1000 + n, " ".join(first[:130] + rng.choices(vocabulary, k=70))) for n in range(12)]
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    kept = {r.doc_id for r in simhash.one_of_each(frame).collect()}
    assert kept == {0, *range(1000, 1012)}


@pytest.mark.parametrize("n", [20, 400])
def test_a_star_of_similar_texts(spark, n):
    """Copies at or above 0.8 to one original and below 0.8 to each other hang together only through it; a second star must stay apart."""
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(3000)]
    rows = []
    for star in (0, 10_000):
        first = rng.choices(vocabulary, k=200)
        texts = [first, *(edited(rng, first, vocabulary, 4) for _ in range(n))]
        rows += [(star + i, " ".join(t)) for i, t in enumerate(texts)]
        assert all(wide_similarity(rows[-n - 1][1], t) >= 0.8 for _, t in rows[-n:])
        assert sum(wide_similarity(rows[-1][1], t) >= 0.8 for _, t in rows[-n:-1]) < n / 10
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id int, text string").repartition(5)).collect()}
    assert kept == {0, 10_000}


def test_texts_with_a_common_passage_are_not_all_compared(spark, monkeypatch, tmp_path):
    """One band of dissimilar texts with a long passage in common: all pairs at 0.8 or more are found without comparing all with all."""
    rng = random.Random(13)
    vocabulary = [f"word{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    texts = [passage[: rng.randrange(50, 61)] + rng.choices(vocabulary, k=rng.randrange(20, 50)) for _ in range(160)]
    texts += [edited(rng, texts[n], vocabulary, 1 + n % 3) for n in range(0, 160, 4)]
    texts = [" ".join(t) for t in texts]
    near = {(4 * n, 160 + n) for n in range(40) if wide_similarity(texts[4 * n], texts[160 + n]) >= 0.8}
    spark.createDataFrame(list(enumerate(texts)), "node bigint, text string").selectExpr("*", "array(7L, 7L) AS bands").write.parquet(str(tmp_path / "nodes"))
    nodes, compared = spark.read.parquet(str(tmp_path / "nodes")), simhash.compared
    counts = []

    def counted(members, leaders):
        counts.append(compared(members, leaders).count())
        return compared(members, leaders)

    monkeypatch.setattr(simhash, "compared", counted)
    got = {(r.lo, r.hi) for r in simhash.similar_links(nodes.select("node", "text", "bands"), lambda wanted: wanted.select("node", "text")).collect()}
    assert got == near and 10 < len(near) < 40
    assert sum(counts) < 5 * len(texts)


def test_bands_hold_whole_sets():
    assert simhash.band_keys(simhash.shingle_set(None)) == []
    words = [f"w{i % 5000}" for i in range(70_000)]
    keys = simhash.band_keys(simhash.shingle_set(" ".join(words)))
    assert len(set(keys)) == simhash.BANDS
    assert keys == simhash.band_keys(simhash.shingle_set("\n".join(words).upper()))
    assert len(simhash.shingle_set(" ".join(words))) == 5000
    assert [len(simhash.shingle_set(t)) for t in ("a", "a b c d", "a b c d e", "a b c d e f")] == [1, 1, 1, 2]
