"""Hand-made frames: rows are dicts, columns not named are NULL."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T


def frame(spark, ddl: str, rows: list[dict]):
    schema = T.StructType.fromDDL(ddl)
    unknown = {k for r in rows for k in r} - set(schema.names)
    assert not unknown, unknown
    data = []
    for r in rows:
        values = []
        for f in schema.fields:
            v = r.get(f.name)
            if v is not None and isinstance(f.dataType, T.DecimalType):
                v = Decimal(str(v))
            values.append(v)
        data.append(tuple(values))
    return spark.createDataFrame(data, schema)


def by(df, *keys):
    """Rows as dicts by key (a tuple for several keys)."""
    out = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        out[key[0] if len(keys) == 1 else key] = r.asDict()
    return out


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
