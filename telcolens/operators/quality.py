"""Data-quality checks that replace constraint enforcement: primary keys (A4), foreign keys (A5), and
declared lengths / precisions (A6). Each check is an independent job returning a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telcolens.sources.schemas import TABLES

NULL_KEY = "<null>"


def key_text(cols: Iterable[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in cols])


def pk_violations(tables: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """A4: per table, every key value that repeats or has a null part: (table_name, key_value, n_rows).

    A group-by on the key; partial aggregation happens before the shuffle."""
    parts = []
    for name, cols in keys.items():
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        parts.append(
            tables[name]
            .groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | any_null)
            .select(F.lit(name).alias("table_name"), key_text(cols).alias("key_value"), "n_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """A5 detail: child key values (non-null) with no parent row, and how many child rows carry each.

    The child is reduced to one row per key value before the anti join; Spark broadcasts the parent
    keys only when its size checks allow, else both sides are shuffled on the key."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    parent_keys = parent.select(F.col(parent_column).alias(column))
    return keys.join(parent_keys, column, "left_anti")


def as_parent_key(column: str, child: T.DataType, parent: T.DataType) -> str:
    """SQL for a child key in the parent's text form. A value that the parent's type can't hold gets a
    form that no parent key has."""
    text = f"CAST(`{column}` AS STRING)"
    if child == parent:
        return text
    cast = f"try_cast(`{column}` AS {parent.simpleString()})"
    same = f"{cast} IS NOT NULL"
    if isinstance(child, T.NumericType) and isinstance(parent, T.NumericType):
        same = f"{cast} = `{column}`"
    return f"CASE WHEN `{column}` IS NULL THEN NULL WHEN {same} THEN CAST({cast} AS STRING) ELSE concat('not a key: ', {text}) END"


def fk_summary(
    tables: Mapping[str, DataFrame], fks: Iterable[tuple[str, str, str, str]]
) -> DataFrame:
    """A5: one row per foreign key: (table_name, column_name, parent_table, orphan_rows, orphan_keys).

    One pass per table: all key columns of a child are unpivoted into (fk, parent, key) rows in a single
    scan, aggregated map-side, and matched once against the distinct keys of all parents, of which each
    is read once whatever the number of its children. Keys are compared as the parent's type: a child
    value is cast to it and, where that changes the value, is an orphan."""
    fks = list(fks)
    spark = next(iter(tables.values())).sparkSession
    parents = {p: i for i, p in enumerate(dict.fromkeys((f[2], f[3]) for f in fks))}
    by_child: dict[str, list[tuple[int, int, str]]] = {}
    for i, (child, column, parent, pcol) in enumerate(fks):
        key = as_parent_key(column, tables[child].schema[column].dataType, tables[parent].schema[pcol].dataType)
        by_child.setdefault(child, []).append((i, parents[parent, pcol], key))

    def tagged(df: DataFrame, items: list[tuple[int, int, str]]) -> DataFrame:
        cells = ", ".join(f"{i}, {p}, {key}" for i, p, key in items)
        return df.selectExpr(f"stack({len(items)}, {cells}) AS (fk, parent, key)")

    child_keys = reduce(
        DataFrame.unionByName, [tagged(tables[child], items) for child, items in by_child.items()]
    )
    counts = child_keys.where("key IS NOT NULL").groupBy("fk", "parent", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    parent_keys = reduce(
        DataFrame.unionByName,
        [
            tables[parent].selectExpr(f"{i} AS parent", f"CAST(`{pcol}` AS STRING) AS key")
            for (parent, pcol), i in parents.items()
        ],
    ).distinct().withColumn("_parent", F.lit(True))
    # A left join + "no parent" filter rather than an anti join: Spark would push an anti join below
    # the aggregate and the union (onto raw child rows, with the parent keys copied per child).
    orphans = (
        counts.join(parent_keys, ["parent", "key"], "left")
        .where("_parent IS NULL")
        .groupBy("fk")
        .agg(F.sum("n_rows").cast("bigint").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    )
    # One metadata row per foreign key (bounded by the list of keys), so clean keys report zeros.
    values = ", ".join(f"({i}, '{c}', '{col}', '{p}')" for i, (c, col, p, _) in enumerate(fks))
    meta = spark.sql(f"SELECT * FROM VALUES {values} AS m(fk, table_name, column_name, parent_table)")
    return meta.join(orphans, "fk", "left").selectExpr(
        "table_name",
        "column_name",
        "parent_table",
        "coalesce(orphan_rows, CAST(0 AS BIGINT)) AS orphan_rows",
        "coalesce(orphan_keys, CAST(0 AS BIGINT)) AS orphan_keys",
    )


def domain_checks(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, int]]:
    """(table, column, rule, limit) for every declared length / precision whose column is present
    with a matching type. Rules: ``max_length`` (characters, ``varchar2(n char)``), ``max_bytes``
    (``varchar2(n)``, byte semantics), ``max_digits`` (``number(n)``)."""
    out = []
    for name, df in tables.items():
        if name not in TABLES:
            continue
        types = dict(df.dtypes)
        for col in TABLES[name].columns:
            t = types.get(col.name)
            if t is None:
                continue
            if col.max_len is not None and t == "string":
                out.append((name, col.name, "max_bytes" if col.byte_len else "max_length", col.max_len))
            if col.max_digits is not None and (t in ("bigint", "int") or t.startswith("decimal")):
                out.append((name, col.name, "max_digits", col.max_digits))
    return out


def domain_violations(
    tables: Mapping[str, DataFrame], checks: list[tuple[str, str, str, int]] | None = None
) -> DataFrame:
    """(table_name, column_name, rule, limit_value, violations) with one pass per table: one
    aggregate row of counts per table, unpivoted with ``stack``."""
    checks = domain_checks(tables) if checks is None else checks
    by_table: dict[str, list[tuple[str, str, int]]] = {}
    for table, column, rule, limit in checks:
        by_table.setdefault(table, []).append((column, rule, limit))
    parts = []
    for table, items in by_table.items():
        aggs = []
        for i, (column, rule, limit) in enumerate(items):
            if rule == "max_length":
                bad = f"length(`{column}`) > {limit}"  # characters
            elif rule == "max_bytes":
                bad = f"octet_length(`{column}`) > {limit}"  # UTF-8 bytes
            else:
                bad = f"abs(`{column}`) >= {10**limit}"
            aggs.append(F.expr(f"count_if({bad}) AS v{i}"))
        cells = ", ".join(
            f"'{column}', '{rule}', CAST({limit} AS BIGINT), v{i}" for i, (column, rule, limit) in enumerate(items)
        )
        parts.append(
            tables[table].agg(*aggs).selectExpr(
                f"'{table}' AS table_name",
                f"stack({len(items)}, {cells}) AS (column_name, rule, limit_value, violations)",
            )
        )
    return reduce(DataFrame.unionByName, parts)
