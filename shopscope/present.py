"""Presentation of results at the driver boundary.

The library computes money and ratios as exact DECIMAL and keys dates as
DATE. Compared through pandas, those types come out differently per engine
(DECIMAL as Python ``Decimal`` from Spark but float64 from DuckDB, DATE as
``date`` vs datetime64). The registered queries therefore present every
DECIMAL column as DOUBLE and every DATE column as a midnight TIMESTAMP,
converted the same way in both engines: through DECIMAL(18, s) when the
value fits (one correctly rounded int64 / 10^s division), directly
otherwise. The exact rounding happened before; this is a final cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            s = f.dataType.scale
            fits = F.abs(c) < F.lit(10 ** (18 - s))
            c = (F.when(fits, c.cast(T.DecimalType(18, s)).cast("double"))
                  .otherwise(c.cast("double")))
        elif isinstance(f.dataType, T.DateType):
            c = c.cast(T.TimestampNTZType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def present_sql(sql: str, columns: list[tuple[str, str]]) -> str:
    """Wrap DuckDB SQL so its DECIMAL / DATE columns are presented like
    :func:`present` (``columns``: name and DuckDB type of each output)."""
    repl = []
    for name, typ in columns:
        q = '"' + name.replace('"', '""') + '"'
        t = typ.upper()
        if t.startswith("DECIMAL"):
            s = int(t[t.index(",") + 1:t.index(")")])
            repl.append(f"CASE WHEN abs({q}) < {10 ** (18 - s)} THEN CAST(CAST({q} AS DECIMAL(18,{s})) AS DOUBLE) "
                        f"ELSE CAST({q} AS DOUBLE) END AS {q}")
        elif t == "DATE":
            repl.append(f"CAST({q} AS TIMESTAMP) AS {q}")
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS presented"
