import datetime as dt

import duckdb

from kinfold.llm import urlfilter
from kinfold.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from tools.check import table

SF = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    frame = QUERIES["op6_url_filter"](spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    result = duck.execute(ORACLES["op6_url_filter"])
    want = table([d[0] for d in result.description], result.fetchall())
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == want and {r.blocked for r in frame.select("blocked").distinct().collect()} == {True, False}


def test_captures_are_judged_by_the_list_of_their_day(spark):
    day = lambda n: dt.date(2024, 1, n)
    entries = [
        ("ads", "bad.org", day(5), "add"), ("ads", "bad.org", day(6), "add"), ("ads", "bad.org", day(10), "remove"), ("ads", "bad.org", day(20), "add"),
        ("spam", "x.bad.org", day(1), "add"), ("ads", "tie.net", day(3), "add"), ("ads", "tie.net", day(3), "remove"),
        (None, "bad.org", day(1), "add"), ("ads", None, day(1), "add"), ("ads", "bad.org", None, "add"), ("ads", "bad.org", day(1), None),
    ]
    frame = spark.createDataFrame(entries, "list string, host string, day date, action string")
    urls = [
        (1, "http://bad.org/a", day(4), ""), (2, "http://bad.org", day(5), "ads"), (3, "http://BAD.org.:80/x", day(9), "ads"), (4, "http://bad.org", day(10), ""),
        (5, "https://u:p@x.bad.org/", day(25), "ads,spam"), (6, "http://notbad.org", day(25), ""), (7, "http://tie.net", day(4), ""),
        (8, None, day(25), ""), (9, "no url", day(25), ""), (10, "http://bad.org", None, ""), (None, "http://bad.org", day(25), "ads"),
        (2, "http://bad.org", day(5), "ads"), (11, "http://org", day(25), ""), (12, "", day(25), ""),
    ]
    captures = spark.createDataFrame([u[:3] for u in urls], "page_id int, url string, day date").withColumn("list", F.lit("clash"))
    got = sorted(((r.page_id, r.lists, r.blocked) for r in urlfilter.filter_captures(captures, frame).collect()), key=repr)
    assert got == sorted(((i, x, x != "") for i, _, _, x in urls), key=repr)
    assert urlfilter.filter_captures(captures, frame.limit(0)).filter("blocked").isEmpty()
    assert urlfilter.filter_captures(captures.limit(0), frame).collect() == []
