"""Many report dates from stored day and month aggregates.

A tile holds mergeable measures of one key in one day or month. A store of tiles is a Parquet folder, partitioned by level and month, that each batch of facts
appends to: rows of equal key and tile are merged when read, so late facts need no rewrite. A window ``[as_of - n months, as_of]`` is
whole months, whole days between, and the facts of its two edges, which are read as rows with a pushed-down time filter, so results are those
of the direct report. Facts without a time lie outside every window.

Any number of report dates is answered together: the pieces of all windows are a table of at most (days of a month * 2 + months + 2) rows a date, built on the
driver and broadcast. Tiles are merged after a map-side combine, so a key with a third of all facts is a row a task.

Distinct counts (``distinct`` of a tile) are exact sets that merge: bitmaps of 32,768 ids by id bucket. Dense ids take a bit each; an id that is alone in
its bucket takes 4 KB, whatever its value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolens.functions.timewin import MONTH_COLUMN, AsOf, as_datetime, months_before, ts_lit

DAY, MONTH = "day", "month"
ID = "_id"  # a value of the distinct column


@dataclass(frozen=True)
class Tile:
    """What a store holds: the aggregates of ``keys``; ``measures`` name -> (SQL over facts, name of the merging aggregate).
    With ``distinct`` (an integer column) it also holds that column's set, in rows by bucket."""

    time: str
    keys: tuple[str, ...]
    measures: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    distinct: str | None = None

    @property
    def group(self) -> tuple[str, ...]:
        return (*self.keys, "bucket") if self.distinct else self.keys

    @property
    def values(self) -> tuple[str, ...]:
        return (*self.measures, "bits") if self.distinct else tuple(self.measures)

    def merges(self, types: Mapping[str, str]) -> list[Column]:
        return [F.expr(f"CAST({fn}(`{name}`) AS {types[name]}) AS `{name}`") for name, (_, fn) in self.measures.items()]

    def of_tiles(self, types: Mapping[str, str]) -> list[Column]:
        return [*self.merges(types), *([F.bitmap_or_agg("bits").alias("bits")] if self.distinct else [])]

    @property
    def entry(self) -> tuple[str, ...]:
        return (*self.keys, ID) if self.distinct else self.keys

    def entries(self, facts: DataFrame, *more: str) -> DataFrame:
        """The measures of ``facts`` by ``more`` and keys; with ``distinct``, by its value too."""
        if self.distinct:
            facts = facts.withColumn(ID, F.col(self.distinct).cast("long"))
        by = facts.groupBy(*more, *self.entry)
        return by.agg(*(F.expr(sql).alias(name) for name, (sql, _) in self.measures.items())) if self.measures else facts.select(*more, *self.entry).distinct()

    def merged(self, entries: DataFrame, *more: str) -> DataFrame:
        """``entries`` of which several are alike, as one."""
        by, types = entries.groupBy(*more, *self.entry), dict(entries.dtypes)
        return by.agg(*self.merges(types)) if self.measures else entries.select(*more, *self.entry).distinct()

    def sets(self, entries: DataFrame, *more: str) -> DataFrame:
        """Tiles of ``entries``. A set is made where all its values are, at most 32,768 rows: a part of one would be 4 KB for a few values."""
        if not self.distinct:
            return entries
        types = dict(entries.dtypes)
        entries = entries.withColumn("bucket", F.bitmap_bucket_number(ID))  # a fact without an id has a null bucket and an empty set
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(ID)).alias("bits")
        return entries.repartition(*more, *self.group).groupBy(*more, *self.group).agg(*self.merges(types), bits)

    def grouped_facts(self, facts: DataFrame, *more: str) -> DataFrame:
        return self.sets(self.entries(facts, *more), *more)


def day_and_month_tiles(facts: DataFrame, tile: Tile) -> DataFrame:
    """The tiles of ``facts``: one aggregation to days, of which months are made; neither is aggregated again."""
    days = tile.entries(facts.where(F.col(tile.time).isNotNull()).withColumn("start", F.to_date(tile.time)), "start")
    months = tile.merged(days.withColumn("start", F.trunc("start", "month")), "start")
    levels = [tile.sets(df, "start").select(F.lit(level).alias("level"), "start", *tile.group, *tile.values) for level, df in ((DAY, days), (MONTH, months))]
    return reduce(DataFrame.unionByName, levels).withColumn(MONTH_COLUMN, F.trunc("start", "month"))


def append_tiles(facts: DataFrame, tile: Tile, path: str) -> None:
    """Adds the tiles of a batch of facts to the store at ``path``."""
    tiles = day_and_month_tiles(facts, tile)
    tiles.hint("rebalance", "level", MONTH_COLUMN).write.mode("append").partitionBy("level", MONTH_COLUMN).parquet(path)


@dataclass(frozen=True)
class Pieces:
    months: tuple[date, ...]
    days: tuple[date, ...]
    edges: tuple[tuple[datetime, datetime, bool], ...]  # from, to, to included


def pieces(as_of: AsOf, months: int) -> Pieces:
    """The window ``[as_of - months, as_of]`` as whole months, whole days and edges, without overlap."""
    lo, hi = months_before(as_of, months), as_datetime(as_of)
    first = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    first = first if first == lo else first + timedelta(days=1)
    last = hi.replace(hour=0, minute=0, second=0, microsecond=0)
    if first > last:
        return Pieces((), (), ((lo, hi, True),))
    edges = [(lo, first, False)] if lo < first else []
    whole, days, day = [], [], first.date()
    while day < last.date():
        after = (day.replace(day=1) + timedelta(days=32)).replace(day=1)
        if day.day == 1 and after <= last.date():
            whole.append(day)
            day = after
        else:
            days.append(day)
            day += timedelta(days=1)
    return Pieces(tuple(whole), tuple(days), (*edges, (last, hi, True)))


def in_edge(time: Column, edge: tuple[datetime, datetime, bool]) -> Column:
    a, b, included = edge
    return (time >= ts_lit(a)) & ((time <= ts_lit(b)) if included else (time < ts_lit(b)))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def with_dates(facts: DataFrame, when: Mapping[datetime, Column]) -> DataFrame:
    """The rows of ``facts`` once per report date (``as_of``) whose condition they meet, in one scan; the dates' conditions reach the scan."""
    hits = F.array_compact(F.array(*[F.when(c, ts_lit(d)) for d, c in when.items()]))
    return facts.where(any_of(when.values())).withColumn("as_of", F.explode(hits))


def at_dates(spark: SparkSession, path: str, facts: DataFrame, tile: Tile, as_ofs: Iterable[AsOf], months: int) -> DataFrame:
    """(as_of, keys, measures; with ``distinct``: bucket, bits) of the last ``months`` months at each report date: the store's
    whole tiles and the edge rows of ``facts``."""
    of = {as_datetime(a): pieces(a, months) for a in as_ofs}
    starts = [(d, level, s) for d, p in of.items() for level, x in ((MONTH, p.months), (DAY, p.days)) for s in x]
    edge = with_dates(facts, {d: any_of(in_edge(F.col(tile.time), e) for e in p.edges) for d, p in of.items()})
    if MONTH_COLUMN in facts.columns:
        seen = sorted({d.date().replace(day=1) for p in of.values() for a, b, _ in p.edges for d in (a, b)})
        edge = edge.where(F.col(MONTH_COLUMN).isin(seen))
    edge = tile.grouped_facts(edge, "as_of")
    columns = ["as_of", *tile.group, *tile.values]
    both, types = edge.select(*columns), dict(edge.dtypes)
    if starts:
        wanted = spark.createDataFrame(starts, "as_of timestamp_ntz, level string, start date")
        held = spark.read.parquet(path).where(F.col(MONTH_COLUMN).isin(sorted({s.replace(day=1) for _, _, s in starts})))
        both = held.join(F.broadcast(wanted), ["level", "start"]).select(*columns).unionByName(both)
    return both.groupBy("as_of", *tile.group).agg(*tile.of_tiles(types))


def set_size() -> Column:
    """The size of a set, over its merged rows (one a bucket)."""
    return F.sum(F.bitmap_count("bits")).cast("bigint")
