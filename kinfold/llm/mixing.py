"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame expressions only.

A source's target is its weighted share of all words, at most ``MOST`` times its own words; what it cannot take is shared among the others by
weight, until none is above. The words of a source are dealt into shards and cut there into blocks of equal length. The number of blocks that a source gives
is found by highest quotients (Sainte-Laguë: share / 1, share / 3, share / 5, ...), and by the same rule its blocks are shared among its shards. In
a shard the documents stand in a seeded order; every block is taken equally often, and the blocks that are taken once more are spread evenly from a seeded start, so
no row per block is made.

Only (key, source, size) of the documents is shuffled, once. A shard holds about ``SHARD_WORDS`` words or ``SHARD_ROWS`` documents of one source, whatever share of
the rows that source has. Candidates for the last seats are at most a few per party, and they are ranked by a range sort, so no task ranks all parties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.operators.skew import hot_keys, salted_join
from kinfold.operators.ordered import number_rows
from kinfold.session import materialize

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
MOST = 3  # times that a text may be taken
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 17
SHARD_ROWS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with a dense number from 0 in the given order; sorted by ranges, not in one task."""
    return number_rows(rows.orderBy(*order), 0, name)


def capped_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (weight, words) with ``target`` and ``full``, true where the target is ``most`` times the words.

    Targets are proportional to the weights and sum up to all words. Each pass takes the sources that are above their limit out of the sharing; it
    costs one row at the driver, and there are as many passes as levels of limits.
    """
    total = F.sum("words")
    level, limit = None, F.col("words") * most
    while True:
        full = F.lit(False) if level is None else limit < F.lit(level) * F.col("weight")
        row = sources.agg(
            total.alias("all"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if not row["all"] or not row["open"]:
            new = 0.0
        else:
            new = (row["all"] - row["held"]) / row["open"]
        if new == level:
            break
        level = new
    full = limit < F.lit(level) * F.col("weight")
    return sources.withColumn("full", full).withColumn("target", F.when(full, limit.cast("double")).otherwise(F.lit(level) * F.col("weight")))


def apportion(parties: DataFrame, group: list[str], party: str, claim: str, seats: str, limit: str, name: str) -> DataFrame:
    """``parties`` with ``name``, the seats of each party: the ``seats`` of its group go to the highest quotients claim / (2 k + 1).

    Equal quotients go to the smaller ``party``, and no party gets more than ``limit``. With m parties of a group and claims that sum up to c, every quotient above
    (c / (seats - m / 2)) / 2 surely has a seat and none below (c / (seats + m / 2)) / 2 has, which leaves a few candidates for each party; these are ranked.
    """
    sums = parties.groupBy(*group).agg(F.sum(claim).alias("_all"), F.count(F.lit(1)).alias("_m"), F.max(seats).alias("_seats"))
    met = parties.join(sums, group)
    share = F.try_divide(F.col(claim), F.col("_all"))  # null where there is nothing to claim
    low = F.floor(share * F.greatest(F.col("_seats") - F.col("_m") / 2, F.lit(0)) + 0.5) - 1
    high = F.floor(share * (F.col("_seats") + F.col("_m") / 2) + 0.5) + 1
    bounds = {
        "_low": F.least(F.greatest(F.coalesce(low, F.lit(0)), F.lit(0)), F.col(limit)),
        "_high": F.when(F.col(claim) > 0, F.least(high, F.col(limit))).otherwise(0),
    }
    # Seats that are sure stay a number; the others are candidates in a row of their own.
    held = materialize(met.withColumns(bounds), "parties")
    rest = held.filter("_high > _low").select(*group, party, claim, F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"))
    quotient = F.col(claim) / (2 * F.col("_k") + 1)
    order = [*[F.col(c) for c in group], F.col("_quotient").desc(), F.col(party), F.col("_k")]
    numbered = materialize(ranked(rest.withColumn("_quotient", quotient), order, "_at"), "quotients")
    sure = held.groupBy(*group).agg((F.max("_seats") - F.sum("_low")).alias("_left"))
    opens = numbered.groupBy(*group).agg(F.min("_at").alias("_first")).join(sure, group)
    won = numbered.join(opens, group).filter(F.col("_at") - F.col("_first") < F.col("_left"))
    more = won.groupBy(*group, party).agg(F.count(F.lit(1)).alias("_more"))
    out = held.join(more, [*group, party], "left").withColumn(name, (F.col("_low") + F.coalesce("_more", F.lit(0))).cast("bigint"))
    return out.select(*parties.columns, name)


def _digits(*parts: Column) -> Column:
    """60 bits of a seeded digest, the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("bigint")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = 12,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_word, shard): one row per row of ``docs``.

    ``size`` counts the words of the text (null: 0), ``source_size`` and ``target`` those of the source and of its part of the mix, ``taken`` the words of this
    document that the mix takes, repeats counted. ``first_word`` is where its text starts in its shard's order. A null source is a source of its own and
    comes last. Null and empty texts have no words and nothing is taken of them; a source without words has target 0. Rows with one id stand beside each other
    in a shard; which of several equal rows comes first makes no difference to the rows returned. An empty table gives no rows. Other columns are not read.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    source = F.col(source_col).cast("string")
    named = F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))  # a join key that is never null
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), named.alias("named"), size.alias("size")), "sizes")
    totals = sized.groupBy("source", "named").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    numbered = ranked(totals, [F.col("source").asc_nulls_last()], "src")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    shards = F.greatest(F.ceil(F.col("words") / shard_words), F.ceil(F.col("rows") / shard_rows), F.lit(1))
    sources = materialize(numbered.withColumns({"weight": weight, "shards": shards.cast("bigint")}), "sources")
    sources = materialize(capped_targets(sources, most), "targets")

    # Documents by source and shard, in a seeded order within the shard.
    place = _digits(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    dealt = salted_join(sized.select("named", "doc_id", "size", place.alias("place")), sources.select("named", "src", "shards"), ["named"], hot_keys(sources, ["named"], rows="rows"))
    dealt = dealt.select("doc_id", "size", "src", F.pmod("place", "shards").alias("shard"), F.expr("place div shards").alias("place"))
    parts = dealt.groupBy("src", "shard").agg(F.sum("size").alias("length"))
    parts = parts.withColumn("blocks", F.ceil(F.col("length") / block_words).cast("bigint"))
    parts = materialize(parts, "shards")

    # How many blocks each source gives: full ones all blocks ``most`` times, the others by quotients.
    blocks = parts.groupBy("src").agg(F.sum("blocks").alias("blocks"))
    limit = F.col("blocks") * most
    claim = F.when(F.col("words") > 0, F.col("target") * F.col("blocks") / F.col("words")).otherwise(0.0)
    claims = sources.join(blocks, "src").select("src", "full", limit.alias("limit"), claim.alias("claim"))
    open_ = claims.filter("NOT full")
    # A missing row means that no source is open.
    house = F.coalesce(F.lit(open_.agg(F.floor(F.sum("claim") + 0.5)).first()[0]), F.lit(0)).cast("bigint")
    open_ = open_.withColumns({"house": house, "one": F.lit(0)})
    given = apportion(open_, ["one"], "src", "claim", "house", "limit", "quota").select("src", "quota")
    quotas = given.unionByName(claims.filter("full").select("src", F.col("limit").cast("bigint").alias("quota")))

    # The blocks of a source by shard, and where the spread of its last blocks starts.
    shares = parts.join(quotas, "src").withColumns({"claim": F.col("blocks").cast("double"), "limit": F.col("blocks") * most})
    by_shard = apportion(shares, ["src"], "shard", "claim", "quota", "limit", "give")
    start = F.when(F.col("blocks") > 0, _digits(F.lit(seed), F.lit("start"), F.col("src"), F.col("shard")) % F.col("blocks"))
    by_shard = by_shard.select("src", "shard", "blocks", "give", F.coalesce(start, F.lit(0)).alias("start"))
    by_shard = materialize(by_shard.join(sources.select("src", "source", F.col("words").alias("source_size"), "target"), "src"), "gives")

    order = Window.partitionBy("src", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ended = dealt.withColumn("end", F.sum("size").over(order))
    met = ended.join(by_shard, ["src", "shard"])
    first = F.col("end") - F.col("size")
    rounds, extra = F.expr("give div greatest(blocks, 1)"), F.expr("give % greatest(blocks, 1)")

    def spread(position: Column) -> Column:
        """Words before ``position`` of the shard's order that stand in blocks taken once more."""
        block = F.floor(position / block_words)

        def before(n: Column) -> Column:
            steps = F.greatest(F.col("blocks"), F.lit(1))
            return F.floor((n + F.col("start")) * extra / steps) - F.floor(F.col("start") * extra / steps)

        return before(block) * block_words + (position - block * block_words) * (before(block + 1) - before(block))

    taken = rounds * F.col("size") + spread(F.col("end")) - spread(first)
    return met.select(
        "doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("bigint").alias("taken"),
        first.alias("first_word"), "shard",
    )
