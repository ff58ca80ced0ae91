import re
from collections import Counter

import duckdb
from hypothesis import given, settings, strategies as st

from kinfold.llm import quality_rules as rules
from kinfold.llm.queries import ORACLES, QUERIES
from tools.check import table

SF = "/root/testdata/sf0.01"


def plain_repeats(words):
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(hit)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert rules.repeated_words(words) == plain_repeats(words)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#\n\t\x0b\xa0|", max_size=60))
def test_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    got = rules.counts_of(text)
    assert got[:3] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
    assert got[3:5] == (len(lines), len(lines) - len(set(lines)))


def test_query_matches_sql(spark):
    frame = QUERIES["op8_quality_rules"](spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = duck.execute(ORACLES["op8_quality_rules"])
    want = table([d[0] for d in result.description], result.fetchall())
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == want


def test_a_bad_host_takes_its_good_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "short", "bad") for i in range(90)] + [(100, good, "bad")] + [(200 + i, good, f"h{i % 20}") for i in range(100)]
    rows += [(400, "short", "tiny")]
    got = {r.doc_id: r for r in rules.apply_rules(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert not got[100].base_failed and got[100].host_failed and not got[100].kept
    assert got[200].kept
    assert got[400].rate_base < 0.5 and not got[400].host_failed and not got[400].kept


def test_edges(edge_docs, no_docs):
    rows = rules.apply_rules(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.kept is not None and r.host_failed is not None for r in rows)
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (2, 3, 4))
    assert {r.host_docs for r in rows if r.host is None} == {3}
    assert rules.apply_rules(no_docs).collect() == []
