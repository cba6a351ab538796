"""A2: CSV batches with a second output for the lines that don't fit, where ``load.read_table`` stops at the first.

Every line of the files is read as text and split by Spark's own CSV expression into text fields; each declared column is then cast to its type. A line of another
number of fields, or with a value that the declared type cannot hold, goes to ``rejected`` with the raw line, its file and what is wrong in which
columns. All others are ``good``. So good + rejected = the lines read, but for header lines and blank ones, and no value turns null on the way.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telcolens.functions.timewin import AsOf
from telcolens.sources.load import LOAD_ONLY, conform
from telcolens.sources.schemas import TABLES

# Text forms of dates and times (H1).
DATE_FORM = r"^\\d{4}-\\d{2}-\\d{2}$"
TIME_FORM = r"^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$"


@dataclass(frozen=True)
class Loaded:
    good: DataFrame  # the declared columns, defaults filled (A3)
    rejected: DataFrame  # file, line, errors: array of (column, value, reason)


def _typed(name: str, dtype: T.DataType) -> str:
    """SQL of a text field as its declared type; null where it cannot be."""
    cast = f"try_cast(raw.`{name}` AS {dtype.simpleString()})"
    if isinstance(dtype, T.DateType):
        return f"CASE WHEN raw.`{name}` RLIKE '{DATE_FORM}' THEN {cast} END"
    if isinstance(dtype, T.TimestampNTZType):
        return f"CASE WHEN raw.`{name}` RLIKE '{TIME_FORM}' THEN {cast} END"
    return cast


def read_csv(
    spark: SparkSession,
    path: str,
    table: str,
    load_ts: AsOf,
    columns: Sequence[str] | None = None,
    null_value: str = "",
) -> Loaded:
    """The CSV files below ``path`` as good and rejected rows.

    ``columns`` names the fields of files without a header; else the first line of the first file is the header, and equal
    lines in the other files are theirs. Undeclared fields are read and dropped. An empty field, or ``null_value``, is null."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    lines = lines.where(F.trim("line") != "")
    if columns is None:
        first = lines.first()
        header = first["line"] if first else ""
        columns = next(csv.reader([header]), [])
        lines = lines.where(F.col("line") != header)
    declared = {c.name: c.dtype for c in TABLES[table].columns} | LOAD_ONLY
    known = [c for c in columns if c in declared]
    names = [c if columns.index(c) == i else f"{c}#{i}" for i, c in enumerate(columns)]  # a repeated field is no column
    corrupt = "_corrupt"
    while corrupt in names:
        corrupt += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, corrupt]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "nullValue": null_value}
    raw = lines.withColumn("raw", F.from_csv("line", schema.simpleString() if not names else ", ".join(f"`{f.name}` string" for f in schema), options))
    wrong = [
        f"CASE WHEN raw.`{c}` IS NOT NULL AND {_typed(c, declared[c])} IS NULL THEN "
        f"named_struct('column', '{c}', 'value', raw.`{c}`, 'reason', 'not a {declared[c].simpleString()}') END"
        for c in known
        if not isinstance(declared[c], T.StringType)
    ]
    fields = (
        f"CASE WHEN raw.`{corrupt}` IS NOT NULL THEN named_struct('column', CAST(NULL AS STRING), 'value', "
        f"CAST(NULL AS STRING), 'reason', 'not {len(columns)} fields') END"
    )
    checked = raw.withColumn("errors", F.expr(f"filter(array({', '.join([fields, *wrong])}), e -> e IS NOT NULL)"))
    good = checked.where(F.size("errors") == 0).selectExpr(*[f"{_typed(c, declared[c])} AS `{c}`" for c in dict.fromkeys(known)])
    return Loaded(conform(good, table, load_ts), checked.where(F.size("errors") > 0).select("file", "line", "errors"))
