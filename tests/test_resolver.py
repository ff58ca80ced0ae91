import json
import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import relating
from kinfold.operators.features import with_features
from kinfold.operators.linking import components
from kinfold.plans import resolver
from kinfold.plans.store import ResolverStore, number_rows

SCHEMA = "record_seq bigint, dataSource string, recordId string, payload string"


def person(seq, source="S", **attributes):
    body = {"DATA_SOURCE": source, "RECORD_ID": str(seq), **attributes}
    return (seq, source, str(seq), json.dumps(body))


def grouping(members):
    return {r.record_seq: r.entity_id for r in members.collect()}


def smallest_reachable(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(60) if i != 7],
        "random": [tuple(sorted(rng.sample(range(120), 2))) for _ in range(90)],
    }[shape]
    frame = spark.createDataFrame(edges, "lo bigint, hi bigint")
    want = smallest_reachable({n for e in edges for n in e}, edges)
    for floor in (10, 100_000):
        got = {r.record_seq: r.entity_id for r in components(frame, floor).collect()}
        assert got == {n: root for n, root in want.items() if n != root}


def test_people_resolve_over_different_rules(spark):
    rows = [
        person(1, NAME_FULL="Ada  Quill", DATE_OF_BIRTH="1980-02-03"),
        person(2, NAME_FULL="ada quill", DATE_OF_BIRTH="1980-02-03", ADDR_FULL="1 Elm St"),
        person(3, PRIMARY_NAME_FULL="ADA QUILL", ADDR_FULL="1 elm st"),
        person(4, NAME_FULL="Ada Quill"),
        person(5, NAME_FULL="Bo Reed", ADDR_FULL="1 Elm St", PHONE_NUMBER="5"),
        person(6, NAME_FULL="Cy Moss", ADDR_FULL="1 Elm St", PHONE_NUMBER="5"),
    ]
    records = spark.createDataFrame(rows, SCHEMA)
    done = resolver.resolve(records)
    assert grouping(done.members) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    scored = {
        (r.lo, r.hi): (r.match_key, r.match_level_code)
        for r in resolver.relate_all(resolver.relation_index(records, done.moved)).collect()
    }
    assert scored == {
        (1, 4): ("+NAME", "NAME_ONLY"), (1, 5): ("+ADDRESS", "POSSIBLY_RELATED"), (1, 6): ("+ADDRESS", "POSSIBLY_RELATED"),
        (5, 6): ("+ATTRIBUTES+PHONE", "POSSIBLY_SAME"),
    }


def texts(rng, numbers):
    """Records sharing whole texts, openings, closings and lines in many combinations."""
    line = lambda: f"a common line of text number {rng.randint(0, 12)}"
    return [person(n, TEXT="\n".join(line() for _ in range(rng.randint(1, 4)))) for n in numbers]


@pytest.mark.parametrize("seed", [1, 2])
def test_add_and_delete_equal_a_rebuild(spark, seed):
    rng = random.Random(seed)
    rows = texts(rng, range(40))
    batch = texts(rng, list(range(40, 55)) + [3, 8, 21, 30])
    before = spark.createDataFrame(rows, SCHEMA)
    state = resolver.resolve(before)
    _, change = resolver.add_records(state.keys, state.members, spark.createDataFrame(batch, SCHEMA), "r", floor=5)
    members = change.apply_to_members(state.members)
    merged = {r[0]: r for r in rows} | {r[0]: r for r in batch}
    rebuilt = resolver.resolve(spark.createDataFrame(list(merged.values()), SCHEMA), floor=5)
    assert grouping(members) == grouping(rebuilt.members)
    diff = {r.entityId for r in resolver.affected_diff(state.members, members).collect()}
    touched = [r.entityId for r in change.affected.collect()]
    assert len(touched) == len(set(touched)) and diff <= set(touched)
    assert {grouping(members)[r[0]] for r in batch} <= set(touched)

    gone = rng.sample(sorted(merged), 20)
    leaving = spark.createDataFrame([("S", str(g)) for g in gone] + [("S", "999")], "dataSource string, recordId string")
    keys = change.apply_to_keys(state.keys)
    after = resolver.delete_records(keys, members, leaving, "r")
    left = [r for n, r in merged.items() if n not in gone]
    assert grouping(after.apply_to_members(members)) == grouping(resolver.resolve(spark.createDataFrame(left, SCHEMA)).members)
    assert all(r.op == "DELETE" for r in after.affected.collect())


def test_a_hot_copy_group_and_a_hot_line(spark):
    """A third of the records are one text and every record holds one line: linear work, nothing left out."""
    common = "the same banner stands above every text"
    body = lambda n: f"{common}\n" + (f"an unchanging copy of the text" if n < 40 else f"a text of its own, number {n:05d}")
    rows = [person(n, TEXT=body(n)) for n in range(120)]
    records = spark.createDataFrame(rows, SCHEMA)
    done = resolver.resolve(records, floor=10)
    assert done.links.filter("rule = 'EXACT_TEXT'").count() == 39
    assert set(grouping(done.members).values()) == {0, *range(40, 120)}
    index = resolver.relation_index(records, done.moved, floor=10)
    scored = {(r.lo, r.hi) for r in resolver.relate_all(index).collect()}
    assert scored == {(0, n) for n in range(40, 120)}


def test_redo_drains_to_the_full_result(spark):
    records = spark.createDataFrame(texts(random.Random(5), range(60)), SCHEMA)
    done = resolver.resolve(records)
    index = resolver.relation_index(records, done.moved)
    waiting = relating.deferred_blocks(index, 3)
    drained, batches = resolver.drain_redo(index, 2, 3)
    assert batches == -(-waiting.count() // 2) > 1
    rows = lambda frame: sorted(map(tuple, frame.collect()))
    assert rows(resolver.relate(index, 3, drained)) == rows(resolver.relate_all(index))
    assert rows(resolver.relate(index, 3)) != rows(resolver.relate_all(index))
    empty, none = resolver.drain_redo(index, 2, 10_000)
    assert empty.isEmpty() and none == 0


@pytest.mark.parametrize("holders", [2, 49, 51, 500])
def test_evidence_has_one_form_for_all_sizes(spark, holders):
    rows = [(e, "LINE", bytearray(b"v")) for e in range(holders)] + [(1, "LINE", bytearray(b"w"))]
    index = relating.block_index(spark.createDataFrame(rows, "entity_id bigint, ftype string, value binary"))
    assert sorted((r.lo, r.hi) for r in relating.anchored_pairs(index).collect()) == [(0, e) for e in range(1, holders)]


def test_a_shared_passage_does_not_depend_on_single_lines(spark):
    """2 and 3 share three lines in a row; each line alone also stands in the smaller entity 1, but not in a row."""
    lines = [f"a line of text that is long enough, number {n}" for n in range(3)]
    other = [f"some other line between them, number {n}" for n in range(9)]
    bodies = {
        1: [other[0], lines[0], other[1], lines[1], other[2], lines[2], other[3]],
        2: [other[4], *lines, other[5]],
        3: [other[6], *lines, other[7]],
    }
    records = spark.createDataFrame([person(n, TEXT="\n".join(b)) for n, b in bodies.items()], SCHEMA)
    done = resolver.resolve(records)
    scored = {(r.lo, r.hi): r.match_level_code for r in resolver.relate_all(resolver.relation_index(records, done.moved)).collect()}
    assert scored == {(1, 2): "POSSIBLY_RELATED", (1, 3): "POSSIBLY_RELATED", (2, 3): "POSSIBLY_SAME"}


def test_search_agrees_with_add(spark, folder):
    """A request that add would merge is RESOLVED, a shared date alone finds nothing, and every holder of a value answers."""
    store = ResolverStore(spark, folder)
    store.create()
    store.register(spark.createDataFrame([("S",)], "data_source string"))
    load = lambda rows: spark.createDataFrame([r[1:] for r in rows], "dataSource string, recordId string, payload string")
    held = [person(1, NAME_FULL="Ann Lee", DATE_OF_BIRTH="1980-01-01")]
    store.add(load(held + [person(n, ADDR_FULL="1 Elm St", SSN_NUMBER=str(n)) for n in range(2, 62)]), "a")
    asked = [
        person(0, NAME_FULL="ann  lee", DATE_OF_BIRTH="1980-01-01"), person(0, DATE_OF_BIRTH="1980-01-01"), person(0, NAME_FULL="Ann Lee"),
        person(0, ADDR_FULL="1 elm st"),
    ]
    found = {r.requestJson: json.loads(r.resultJson)["RESOLVED_ENTITIES"] for r in store.search(load(asked)).collect()}
    levels = [[e["MATCH_INFO"]["MATCH_LEVEL_CODE"] for e in found[a[3]]] for a in asked]
    assert levels == [["RESOLVED"], [], ["NAME_ONLY"], ["POSSIBLY_RELATED"] * 60]
    before = store.read("member").select("entity_id").distinct().count()
    store.add(load([person(100, NAME_FULL="ann  lee", DATE_OF_BIRTH="1980-01-01")]), "b")
    assert store.read("member").select("entity_id").distinct().count() == before


def test_ambiguous_relations(spark):
    scored = spark.createDataFrame(
        [(1, 2, "POSSIBLY_SAME"), (1, 3, "POSSIBLY_SAME"), (4, 5, "POSSIBLY_SAME"), (2, 4, "POSSIBLY_RELATED")],
        "lo bigint, hi bigint, match_level_code string",
    ).withColumns({"match_key": F.lit("+LINE"), "errule_code": F.lit("X"), "shared": F.lit(1)})
    flags = {(r.entity_id_lo, r.entity_id_hi): r.is_ambiguous for r in relating.relations(scored, floor=1).collect()}
    assert flags == {(1, 2): True, (1, 3): True, (4, 5): False, (2, 4): False}


def test_null_and_malformed_payload_have_no_features(spark):
    rows = [(1, "S", "1", None), (2, "S", "2", "{oops"), (3, "S", "3", "{}")]
    featured = with_features(spark.createDataFrame(rows, SCHEMA))
    assert all(r.singles == [] and r.lines == [] for r in featured.collect())


def test_store_jobs(spark, folder):
    store = ResolverStore(spark, folder)
    store.create()
    store.register(spark.createDataFrame([("S",)], "data_source string"))
    load = lambda *rows: spark.createDataFrame([r[1:] for r in rows], "dataSource string, recordId string, payload string")
    out = store.add(load(person(1, SSN_NUMBER="9"), person(2, SSN_NUMBER="9"), person(3, "T", SSN_NUMBER="9"), (0, "S", "", "{}")), "a")
    kinds = sorted((r.kind, r.category or "") for r in out.collect())
    assert kinds == [("AFFECTED", ""), ("ERROR", "BAD_INPUT"), ("ERROR", "CONFIG_RELEVANT")]
    assert store.read("member").select("entity_id").distinct().count() == 1
    # The source becomes known; the same record passes and joins.
    store.register(spark.createDataFrame([("T",)], "data_source string"))
    assert store.add(load(person(3, "T", SSN_NUMBER="9")), "b").filter("kind = 'ERROR'").count() == 0
    assert store.read("member").count() == 3
    # An update moves a record out, a second identical load changes nothing.
    for _ in range(2):
        store.add(load(person(2, SSN_NUMBER="8")), "c")
        assert store.read("member").select("entity_id").distinct().count() == 2
    hits = store.search(spark.createDataFrame([("", "", '{"SSN_NUMBER":"8"}'), ("", "", '{"SSN_NUMBER":"7"}')], "dataSource string, recordId string, payload string"))
    found = {r.requestJson: len(json.loads(r.resultJson)["RESOLVED_ENTITIES"]) for r in hits.collect()}
    assert found == {'{"SSN_NUMBER":"8"}': 1, '{"SSN_NUMBER":"7"}': 0}
    gone = store.delete(load(person(2), person(77)), "d")
    assert [r.op for r in gone.filter("kind = 'AFFECTED'").collect()] == ["DELETE"] and gone.filter("kind = 'ERROR'").isEmpty()
    assert store.read("member").count() == 2 and store.read("record").count() == 2


def test_numbers_are_dense(spark):
    rows = number_rows(spark.range(0, 50, 1, 4).select("id"), 100)
    assert sorted(r.record_seq for r in rows.collect()) == list(range(100, 150))


@pytest.mark.parametrize("floor", [2, 100_000])
def test_classes_hold_every_related_pair(spark, floor):
    """2 and 3 share values beside 1, which makes them no pair of their own; the class has them. A hot class is salted."""
    held = {b"a": (1, 2, 3), b"b": (1, 2, 3), b"c": (1, 2), b"d": (2, 3), b"e": tuple(range(1, 400)), b"f": (7,)}
    rows = [(e, "PASSAGE" if v == b"d" else "LINE", bytearray(v)) for v, holders in held.items() for e in holders]
    index = relating.block_index(spark.createDataFrame(rows, "entity_id bigint, ftype string, value binary"), floor)
    classes = relating.relation_classes(index)
    found = {bytes(r.value): (r.anchor, r.n, r.shared, r.match_level_code) for r in classes.collect()}
    related, same = "POSSIBLY_RELATED", "POSSIBLY_SAME"
    assert found == {b"a": (1, 3, 2, related), b"c": (1, 2, 1, related), b"d": (2, 2, 1, same), b"e": (1, 399, 1, related)}
    members = {}
    for r in relating.class_members(index, classes, floor).collect():
        members.setdefault(bytes(r.value), []).append(r.entity_id)
    assert {v: tuple(sorted(m)) for v, m in members.items()} == {v: held[v] for v in found}
    assert relating.class_members(index.limit(0), relating.relation_classes(index.limit(0))).count() == 0
