from __future__ import annotations

import csv
import os
import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import types as T  # noqa: E402

from telcolens.session import build_session  # noqa: E402
from telcolens.sources.load import from_rows, resolve_lookups  # noqa: E402
from telcolens.sources.schemas import TABLES  # noqa: E402

FIXTURES = Path(__file__).resolve().parent / "fixtures"
# The sample rows were written at load time; we fix that time, and the report time, here.
LOAD_TS = datetime(2024, 2, 1, 0, 0, 0)
AS_OF = LOAD_TS
SMOKE_SF = "/root/testdata/sf0.001"
ORACLE_SF = "/root/testdata/sf0.01"


def _value(token: str, dtype: T.DataType):
    """Fixture tokens: NULL = explicit null, SYSDATE = the load time, PHONE_OF:k = lookup."""
    if token == "NULL":
        return None
    if token == "SYSDATE":
        return LOAD_TS
    if isinstance(dtype, T.LongType):
        return int(token)
    if isinstance(dtype, T.DecimalType):
        return Decimal(token)
    if isinstance(dtype, T.DateType):
        return date.fromisoformat(token)
    if isinstance(dtype, T.TimestampNTZType):
        return datetime.fromisoformat(token)
    return token


def read_fixture(name: str) -> tuple[list[str], list[list[object]]]:
    with open(FIXTURES / f"{name}.csv", encoding="utf-8", newline="") as f:
        r = csv.reader(f)
        header = next(r)
        raw = list(r)
    spec = TABLES[name]
    cols = list(header)
    rows: list[list[object]] = []
    lookup = name == "calls"
    if lookup:
        cols.append("receiver_subscriber_id")
    for rec in raw:
        row = []
        for c, tok in zip(header, rec):
            if tok == "SYSDATE" and isinstance(spec.column(c).dtype, T.DateType):
                row.append(LOAD_TS.date())
            elif tok.startswith("PHONE_OF:"):
                row.append(None)
            else:
                row.append(_value(tok, spec.column(c).dtype))
        if lookup:
            tok = rec[header.index("receiver_phone")]
            row.append(int(tok.split(":")[1]) if tok.startswith("PHONE_OF:") else None)
        rows.append(row)
    return cols, rows


def load_fixture(spark, extra: dict[str, tuple[list[str], list[list[object]]]] | None = None):
    """All 14 tables from the transcribed sample rows (plus optional extra batches per table)."""
    tables = {}
    for name in TABLES:
        cols, rows = read_fixture(name)
        df = from_rows(spark, name, cols, rows, LOAD_TS)
        if extra and name in extra:
            ecols, erows = extra[name]
            df = df.unionByName(from_rows(spark, name, ecols, erows, LOAD_TS), allowMissingColumns=True)
        tables[name] = df
    return resolve_lookups(tables)


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    import tempfile

    warehouse = tempfile.mkdtemp(prefix="telcolens-warehouse-")
    s = build_session("local[4]", 4, app_name="telcolens-tests", extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    tables = load_fixture(spark)
    return {k: v.cache() for k, v in tables.items()}
