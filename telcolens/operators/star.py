"""S3: star enrichment by a walk over the declared foreign keys (``sources.schemas``).

From a table, every foreign key leads to a parent, and the parent's own keys lead on (service to tariff, address to its kind).
Each step is one left join on the parent's key, with the growing row as the streamed side, so no row is lost and a hot key is never buffered; AQE can
split it. A step has a role, the name of its key column without ``_id``; where two ways end in one role, the later one is preceded by the role that
it comes from. A parent's column ``x`` is called ``<role>_x``, or ``x`` where it begins with the role already.

One-to-many (the addresses of a subscriber): ``nested`` gives the child rows of each parent key as an array of structs, ordered by their fields. A key
with very many children is cut into parts of about ``PART`` each, so that no array grows with the data: ``part_no`` is 0 for all but such keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.sources.schemas import TABLES

# Children of one key in one array, about.
PART = 1000
# Columns about the row itself rather than what it describes; not taken along.
BOOKKEEPING = {"insert_date", "changed_date"}


@dataclass(frozen=True)
class Step:
    role: str
    child_role: str  # "" for the table that the walk starts from
    child_column: str
    parent: str
    parent_column: str

    @property
    def key(self) -> str:
        """The name of the child's key column in the enriched row."""
        return column_name(self.child_role, self.child_column)


def column_name(role: str, column: str) -> str:
    return column if not role or column == role or column.startswith(role + "_") else f"{role}_{column}"


def walk(start: str, follow: Sequence[str] | None = None) -> list[Step]:
    """The steps from ``start`` over its foreign keys and their parents', breadth first; ``follow`` names the parents
    to go to (all where None). A table is not entered twice on one way, so cycles end."""
    steps, roles = [], set()
    front = [("", start, (start,))]
    while front:
        child_role, child, way = front.pop(0)
        for column, parent, parent_column in TABLES[child].foreign_keys:
            if parent in way or (follow is not None and parent not in follow):
                continue
            role = column.removesuffix("_id")
            if role in roles:
                role = f"{child_role or child}_{role}"
            roles.add(role)
            steps.append(Step(role, child_role, column, parent, parent_column))
            front.append((role, parent, (*way, parent)))
    return steps


def star(
    tables: Mapping[str, DataFrame],
    start: str,
    follow: Sequence[str] | None = None,
    columns: Mapping[str, Sequence[str]] | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Every row of ``start`` (or of ``rows``, which has its columns) with its parents' columns by role. ``columns`` limits the
    columns taken of a parent; by default all but its key and bookkeeping. Keys to tables that are not in ``tables``, or of
    columns that are not there, are not followed."""
    out = tables[start] if rows is None else rows
    for s in walk(start, follow):
        if s.parent not in tables or s.key not in out.columns:
            continue
        parent = tables[s.parent]
        on = [k for k, *_ in TABLES[s.parent].foreign_keys]
        wanted = (columns or {}).get(s.parent)
        taken = [
            c for c in parent.columns
            if c != s.parent_column and (c in on or (c not in BOOKKEEPING if wanted is None else c in wanted))
        ]
        named = [F.col(c).alias(column_name(s.role, c)) for c in taken if column_name(s.role, c) not in out.columns]
        out = out.join(parent.select(F.col(s.parent_column).alias(s.key), *named), s.key, "left")
    return out


def nested(child: DataFrame, key: str, fields: Sequence[str], name: str, part: int = PART) -> DataFrame:
    """(key, part_no, ``name``): the rows of ``child`` per non-null ``key`` as arrays of structs of ``fields``, in their order.

    A key of n rows has ceil(n / part) parts, dealt by a hash of the fields: rows that are equal in all of them share a part."""
    own = child.where(F.col(key).isNotNull()).select(key, *fields)
    parts = own.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / part).alias("_parts")).where("_parts > 1")
    dealt = own.join(parts, key, "left").withColumn(
        "part_no", F.pmod(F.xxhash64(*fields), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    return dealt.groupBy(key, "part_no").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def text_of(array: str, fields: Sequence[str], sep: str = "; ") -> Column:
    """A nested array as one text: ``a: b; a: b`` (null: no rows)."""
    each = ", ': ', ".join(f"coalesce(CAST(x.`{f}` AS STRING), '')" for f in fields)
    return F.expr(f"array_join(transform(`{array}`, x -> concat({each})), '{sep}')")
