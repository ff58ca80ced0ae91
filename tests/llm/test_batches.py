"""What goes back from Python in large batches."""

import random

from pyspark.sql import functions as F

from kinfold.llm import linededup
from kinfold.llm.common import SENT, batches


def test_a_large_batch_after_a_small_one_comes_back_whole(spark):
    rows = spark.range(0, 900, 1, 1)
    made = batches(rows, lambda id: {"id": id, "body": ["x" * (50_000 if i >= 500 else 1) for i in id]}, "id bigint, body string")
    got = made.agg(F.count("id"), F.sum("id"), F.sum(F.length("body"))).first()
    assert tuple(got) == (900, 899 * 450, 500 + 400 * 50_000)


def test_slices_of_long_texts_after_short_ones(spark):
    size = F.when(F.col("id") < 500, 1).otherwise(2 * SENT // 400 // 10).cast("int")
    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit("some line. "), size))
    keyed = spark.range(0, 900, 1, 1).select("id", F.xxhash64(text).alias("content"), text.alias("text"))
    spans = keyed.select("id", "content", F.lit(0).alias("start"), F.length("text").alias("end"))
    got = linededup.slices(keyed, spans).select("body", "end").collect()
    assert len(got) == 900 and all(len(body) == end for body, end in got)


def test_equal_start_is_that_of_a_comparison_line_by_line():
    def plain(left, right, whole):
        taken = 0
        if left.lstrip()[:2] == right.lstrip()[:2] and left.split(None, 1)[:1] == right.split(None, 1)[:1]:
            for mine, other in zip(linededup.LINE.finditer(left), linededup.LINE.finditer(right)):
                edge = mine.end() == len(left) >= linededup.BESIDE or other.end() == len(right) >= linededup.BESIDE
                if not whole and edge or mine.group().strip() != other.group().strip():
                    break
                taken = mine.end()
        return taken

    draw = random.Random(5)
    for _ in range(1500):
        base = "".join(draw.choice("aab.!? \n") for _ in range(draw.choice([5, 40, 600])))
        at = draw.randrange(len(base))
        other = (base[:at] + draw.choice(["", " ", "a", ".", "\n"]) + base[at + draw.choice([0, 1]) :])[:600]
        for whole in (True, False):
            assert linededup.equal_start(base, other, whole) == plain(base, other, whole), (base, other)
            assert linededup.equal_start(other, base, whole) == plain(other, base, whole), (other, base)


def test_equal_end_is_that_of_a_comparison_line_by_line():
    def plain(left, right):
        if left.rstrip()[-2:] != right.rstrip()[-2:] or left.rsplit(None, 1)[-1:] != right.rsplit(None, 1)[-1:]:
            return 0
        taken = len(left)
        mine, other = (linededup.lines_of(t)[len(t) >= linededup.BESIDE :] for t in (left, right))
        for (a, b), (c, d) in zip(reversed(mine), reversed(other)):
            if left[a:b].strip() != right[c:d].strip():
                break
            taken = a
        return len(left) - taken

    draw = random.Random(6)
    for _ in range(3000):
        letters = draw.choice(["aab.!? \n", "ab cd.  \n\t ", "abcdefgh     ..\n\n"])
        base = "".join(draw.choice(letters) for _ in range(draw.choice([0, 5, 40, 600])))
        at = draw.randrange(len(base) + 1)
        other = (base[:at] + draw.choice(["", " ", "a", ".", "\n"]) + base[at + draw.choice([0, 1]) :])[-600:]
        assert linededup.equal_end(base, other) == plain(base, other), (base, other)
        assert linededup.equal_end(other, base) == plain(other, base), (other, base)


def test_equal_ends_are_compared_without_cutting_whole_texts_into_lines(monkeypatch):
    """Of 600 equal characters on each side only those beside the first unequal line are cut into lines."""
    class Counted:
        seen = 0

        def findall(self, text, start=0, end=None):
            Counted.seen += (len(text) if end is None else end) - start
            return line.findall(text, start, len(text) if end is None else end)

        def match(self, text, at):
            return line.match(text, at)

    line = linededup.LINE
    body = "".join(f"This is sentence number {i}. " for i in range(40))
    monkeypatch.setattr(linededup, "LINE", Counted())
    taken = linededup.equal_end(("left. " + body)[-600:], ("right. " + body)[-600:])
    assert taken > 550 and Counted.seen < 600
