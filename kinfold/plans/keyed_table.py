"""A keyed table of versioned rows on plain parquet, in buckets.

Every pass writes one `refresh_seq=N` folder as a whole, so a repeated pass replaces its own rows and a
late pass with a smaller number cannot override a later one. A reader names the last sequence number it
trusts; rows of a pass that did not finish stay invisible. Removed keys are rows with `removed` set.

Within a pass the rows lie in folders by a hash bucket of their key. A read that is restricted to some keys opens the buckets of these keys
only, as a static partition filter. Other columns can be looked up through a narrow second copy of the rows, bucketed by these columns: it says which keys
may hold a value, and the newest version of the key decides. So a small batch neither reads nor writes the rest of the table.
``compact`` restates the table in a new base folder, which bounds the versions per key, with as many buckets as its rows ask for.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from kinfold.schemas import struct
from kinfold.session import PACKED, read_if_exists
from kinfold.sources.changefeed import snapshot_diff

BUCKETS = 16  # of a new table
BUCKET_ROWS = 1_000_000  # rows of a bucket after ``compact``, about


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    row: T.StructType
    keys: tuple[str, ...]
    accumulate: bool = False  # a null column keeps the value of the version before
    bucket_by: tuple[str, ...] = ()  # keys that place a row; all of them by default
    lookups: tuple[tuple[str, ...], ...] = ()  # columns with a copy of their own
    buckets: int = BUCKETS
    base: int = 0

    @property
    def _values(self) -> list[str]:
        return [c for c in self.row.names if c not in self.keys]

    @property
    def _placing(self) -> tuple[str, ...]:
        return self.bucket_by or self.keys

    def _stored(self) -> T.StructType:
        extra = [
            T.StructField("removed", T.BooleanType()), T.StructField("updated_at", T.TimestampType()),
        ]
        return T.StructType([*self.row.fields, *extra])

    def _copy(self, columns: tuple[str, ...]) -> tuple[str, T.StructType]:
        """Folder and row of the copy for a lookup."""
        names = list(dict.fromkeys([*self.keys, *columns]))
        return f"{self.path}_by_{'_'.join(columns)}", T.StructType([self.row[c] for c in names])

    def bucket(self, columns: tuple[str, ...]) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast(self.row[c].dataType) for c in columns]), F.lit(self.buckets)).cast("int")

    def create(self) -> None:
        shapes = [(self.path, self._stored()), *map(self._copy, self.lookups)]
        for path, shape in shapes:
            empty = self.spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in shape])
            empty.write.mode("ignore").parquet(f"{path}/base=0/refresh_seq=0/bucket=0")

    def write(self, seq: int, upserts: DataFrame | None = None, removed: DataFrame | None = None, base: int | None = None) -> None:
        """Store the rows of pass ``seq``. A key both written and removed in one pass is written."""
        if upserts is None and removed is None:
            return
        base = self.base if base is None else base
        rows = []
        if upserts is not None:
            rows.append(upserts.select(*self.row.names).withColumn("removed", F.lit(False)))
        if removed is not None:
            gone = removed.select(*self.keys).distinct()
            if upserts is not None:
                gone = gone.join(upserts.select(*self.keys), list(self.keys), "left_anti")
            blank = [F.lit(None).cast(self.row[c].dataType).alias(c) for c in self._values]
            rows.append(gone.select(*self.keys, *blank, F.lit(True).alias("removed")).select(*self.row.names, "removed"))
        out = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        target = f"{self.path}/base={base}/refresh_seq={seq}"
        self._place(out.withColumn("updated_at", F.current_timestamp()), self._placing, target)
        for columns in self.lookups if upserts is not None else ():
            path, shape = self._copy(columns)
            written = self.spark.read.schema(self._stored()).parquet(target).filter("NOT removed")
            self._place(written.select(*shape.names), columns, f"{path}/base={base}/refresh_seq={seq}")

    def _place(self, rows: DataFrame, columns: tuple[str, ...], target: str) -> None:
        """``rows`` in bucket folders. The hint merges small buckets into one task and splits large ones."""
        placed = rows.withColumn("bucket", self.bucket(columns)).hint("rebalance", "bucket")
        placed.write.mode("overwrite").option("compression", PACKED).partitionBy("bucket").parquet(target)

    def _rows(self, path: str, shape: T.StructType, as_of: int, base: int, since: int, buckets: list[int] | None) -> DataFrame:
        parts = [T.StructField("base", T.IntegerType()), T.StructField("refresh_seq", T.LongType()), T.StructField("bucket", T.IntegerType())]
        rows = read_if_exists(self.spark, path, T.StructType([*shape.fields, *parts]))
        rows = rows.filter((F.col("base") == base) & (F.col("refresh_seq") <= as_of) & (F.col("refresh_seq") >= since))
        if buckets is not None and len(buckets) < self.buckets:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return rows.drop("base", "bucket")

    def versions(self, as_of: int, base: int | None = None, since: int = 0, buckets: list[int] | None = None) -> DataFrame:
        """Stored rows of passes ``since``..``as_of``, of all or some buckets; other folders are never opened."""
        return self._rows(self.path, self._stored(), as_of, self.base if base is None else base, since, buckets)

    def touched(self, only: DataFrame, columns: tuple[str, ...]) -> list[int]:
        """The buckets that the rows of ``only`` fall into, at most as many as there are buckets."""
        return sorted(row[0] for row in only.select(self.bucket(columns)).distinct().collect())

    def read(
        self, as_of: int, columns: list[str] | None = None, base: int | None = None, only: DataFrame | None = None, since: int = 0
    ) -> DataFrame:
        """The table as of a pass: the newest version per key, removed keys left out.

        ``only`` restricts the result to rows that match it on its columns. It is applied to the stored
        versions, before they are grouped, so a small batch does not shuffle the table; its buckets alone are read when its columns
        hold those that place a row, or are a lookup. It is read more than once and should be a stored frame. ``since`` leaves the passes before it
        closed: keys that only these wrote do not show.
        """
        wanted = [c for c in self._values if columns is None or c in columns]
        base = self.base if base is None else base
        names = [*self.keys, *wanted, "removed", "refresh_seq"]
        if only is None:
            return self._newest(self.versions(as_of, base, since).select(*names), wanted)
        match = only.columns
        if set(self._placing) <= set(match):
            rows = self.versions(as_of, base, buckets=self.touched(only, self._placing)).select(*dict.fromkeys([*names, *match]))
            keys = rows.join(only, match, "left_semi")
        elif tuple(match) in self.lookups:
            path, shape = self._copy(tuple(match))
            found = self._rows(path, shape, as_of, base, 0, self.touched(only, tuple(match)))
            keys = found.join(only, match, "left_semi").select(*self.keys).distinct()
            rows = self.versions(as_of, base, buckets=self.touched(keys, self._placing)).select(*dict.fromkeys([*names, *match]))
        else:
            rows = self.versions(as_of, base).select(*dict.fromkeys([*names, *match]))
            keys = rows.join(only, match, "left_semi")
        if set(match) <= set(self.keys) and tuple(match) not in self.lookups:
            return self._newest(keys.select(*names), wanted)
        # A value column: any version may match, but the newest version of the key decides.
        rows = rows.join(keys.select(*self.keys).distinct(), list(self.keys), "left_semi")
        held = list(dict.fromkeys([*wanted, *[c for c in match if c not in self.keys]]))
        newest = self._newest(rows, held).join(only, match, "left_semi")
        return newest.select(*self.keys, *wanted, "refresh_seq")

    def _newest(self, rows: DataFrame, wanted: list[str]) -> DataFrame:
        if self.accumulate:
            # Versions before the last removal no longer count. A key has one row per pass at most.
            per_key = Window.partitionBy(*self.keys)
            rows = rows.withColumn("_cut", F.max(F.when(F.col("removed"), F.col("refresh_seq"))).over(per_key)).filter(
                ~F.col("removed") & (F.col("_cut").isNull() | (F.col("refresh_seq") > F.col("_cut")))
            )
            newest = [F.expr(f"max_by({c}, refresh_seq) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in wanted]
            return rows.groupBy(*self.keys).agg(*newest, F.max("refresh_seq").alias("refresh_seq"))
        newest = rows.groupBy(*self.keys).agg(
            F.max_by(F.struct("removed", *wanted), "refresh_seq").alias("_row"), F.max("refresh_seq").alias("refresh_seq")
        )
        return newest.filter(~F.col("_row.removed")).select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in wanted], "refresh_seq")

    def compact(self, as_of: int, base: int | None = None, buckets: int | None = None) -> int:
        """Restate the table in base ``as_of``; the caller then reads and writes that base, with that number of buckets."""
        replace(self, buckets=buckets or self.buckets).write(as_of, self.read(as_of, base=base), base=as_of)
        return as_of


class VersionedTables:
    """Keyed tables below one folder that move forward together.

    A pass writes every table under the next number and records the number last, in the `_sync_state`
    table. Readers go by the recorded number: a pass shows in all tables at once or not at all, and one
    that stopped half way is simply run again. ``layout`` names, for some tables, the keys that place a row and the lookups.
    """

    SEQ = "refresh_seq"
    STATE = (struct("key string, value string"), ["key"])

    def __init__(self, spark: SparkSession, path: str, shapes: dict, accumulate: tuple[str, ...] = (), layout: dict = {}, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.tables = {}
        for name, (row, keys) in {**shapes, "_sync_state": self.STATE}.items():
            placing, lookups = layout.get(name, ((), ()))
            self.tables[name] = KeyedTable(
                spark, f"{self.path}/{name}", row, tuple(keys), name in accumulate, placing, lookups, 1 if name == "_sync_state" else buckets
            )

    def create(self) -> None:
        for table in self.tables.values():
            table.create()

    def state(self) -> dict[str, str]:
        """The few recorded values; a value of an unfinished pass is overwritten when it is run again."""
        rows = self.tables["_sync_state"].read(2**62).select("key", "value").collect()
        return {row["key"]: row["value"] for row in rows}

    def read_state(self, key: str) -> str | None:
        return self.state().get(key)

    def current(self, state: dict[str, str] | None = None) -> dict[str, KeyedTable]:
        """The tables with the base and the number of buckets they have now."""
        state = self.state() if state is None else state
        base = int(state.get("base", 0))
        held = {n: replace(t, base=base, buckets=int(state.get(f"buckets:{n}", t.buckets))) for n, t in self.tables.items()}
        return held | {"_sync_state": self.tables["_sync_state"]}

    def commit(self, seq: int, **values: object) -> None:
        rows = [(key, str(value)) for key, value in {self.SEQ: seq, **values}.items()]
        self.tables["_sync_state"].write(seq, self.spark.createDataFrame(rows, "key string, value string"))

    @property
    def seq(self) -> int:
        return int(self.read_state(self.SEQ) or 0)

    def read(
        self, table: str, as_of: int | None = None, columns: list[str] | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        state = self.state()
        return self.current(state)[table].read(int(state.get(self.SEQ, 0)) if as_of is None else as_of, columns, only=only)

    def compact(self, bucket_rows: int = BUCKET_ROWS) -> int:
        """Restate all tables as a pass of its own, each with a number of buckets that fits its rows. Earlier passes can no longer be read."""
        state = self.state()
        seq = int(state.get(self.SEQ, 0))
        now, sizes = seq + 1, {}
        for name, table in self.current(state).items():
            if name != "_sync_state":
                rows = table.read(seq).drop("refresh_seq")
                sizes[f"buckets:{name}"] = max(BUCKETS, ceil(rows.count() / bucket_rows))
                replace(table, buckets=sizes[f"buckets:{name}"]).write(now, rows, base=now)
        self.commit(now, base=now, **sizes)
        return now

    def changes(self, table: str, since: int, until: int) -> DataFrame:
        """Row changes of a table between two passes, for downstream readers. Only keys that a pass in
        between wrote are compared, and only their buckets read."""
        held = self.current()[table]
        touched = held.versions(until, since=since + 1).select(*held.keys).distinct()

        def at(seq: int) -> DataFrame:
            return held.read(seq, only=touched).drop("refresh_seq")

        return snapshot_diff(at(since), at(until), list(held.keys))
