"""Driver-facing form of the registered queries and their oracles.

Engines hand types to client code differently: a decimal becomes a Python
``Decimal`` from Spark but a float from DuckDB's pandas conversion, a date a
``datetime.date`` or a ``datetime64``, a nullable integer a float with NaN or
a masked integer.  So that a comparison of the two results does not depend on
those client mappings, the query and its oracle are both brought to the same
portable column types at the boundary:

* decimal                  -> text (exact, scale included)
* date / timestamp         -> ISO text
* integer that may be null -> text
* everything else unchanged

The library functions themselves keep decimals and dates; this applies only
to what ``__spark_entry__`` hands to the driver.  The oracle side needs each
query's column kinds without a Spark session, so they are recorded in
:mod:`.portable_spec` (regenerated by ``tools/gen_portable.py``; a test keeps
it equal to the live schemas).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StructType, TimestampNTZType, TimestampType


def kinds(schema: StructType) -> list[tuple[str, str]]:
    out = []
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (DecimalType, DateType, TimestampType, TimestampNTZType)):
            out.append((f.name, "text"))
        elif isinstance(t, IntegralType) and f.nullable:
            out.append((f.name, "text"))
        else:
            out.append((f.name, "keep"))
    return out


def portable_df(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("string").alias(n) if k != "keep" else F.col(n)
                       for n, k in kinds(df.schema)])


def portable_sql(sql: str, spec: list[tuple[str, str]]) -> str:
    cols = ", ".join(f'cast(q."{n}" as varchar) as "{n}"' if k != "keep" else f'q."{n}"' for n, k in spec)
    return f"select {cols} from (\n{sql}\n) as q"
