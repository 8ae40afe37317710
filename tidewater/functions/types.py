"""Type resolution for one table (SEM-2) and its application (SEM-3)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.config import ColumnMeta, is_framework

# Source type names accepted by the structured layer.
SOURCE_TYPES = {
    "LONG": T.LongType(),
    "BIGINT": T.LongType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "VARCHAR": T.StringType(),
    "CHAR": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}
# Structured-table types a common column may already have.
TABLE_TYPES = (T.DecimalType, T.LongType, T.StringType, T.TimestampType, T.DateType, T.IntegerType)


class UnresolvedTypeError(ValueError):
    """Raised when some column has no resolvable structured type."""


def source_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    n = name.strip().upper()
    m = re.fullmatch(r"(NUMERIC|DECIMAL)\s*(?:\((\d+)\s*,\s*(\d+)\))?", n)
    if m:
        p = int(m.group(2)) if m.group(2) else precision
        s = int(m.group(3)) if m.group(3) else scale
        if p is None or s is None:
            raise UnresolvedTypeError(f"{name} needs precision and scale")
        return T.DecimalType(p, s)
    if n in SOURCE_TYPES:
        return SOURCE_TYPES[n]
    raise UnresolvedTypeError(f"unknown source type {name}")


def resolve_types(columns: list[ColumnMeta], table_schema: T.StructType, table: str,
                  pii_types: dict[str, str] | None = None) -> list[tuple[str, T.DataType]]:
    """SEM-2: PII config first, then CDC metadata for new columns, then the
    existing table's type for common columns. Names are upper-cased once.
    Output keeps CDC column order; every unresolved column is listed in one error.
    """
    existing = {f.name.upper(): f.dataType for f in table_schema.fields if not is_framework(f.name)}
    pii = {k.upper(): v for k, v in (pii_types or {}).items()}
    out, errors = [], []
    for c in columns:
        name = c.upper
        try:
            if c.is_pii:
                if name not in pii:
                    raise UnresolvedTypeError(f"PII column {name} has no configured type")
                dtype = source_type(pii[name])
            elif name in existing:
                dtype = existing[name]
                if not isinstance(dtype, TABLE_TYPES):
                    raise UnresolvedTypeError(
                        f"column {name} of {table} already has type {dtype.simpleString()}, which changes cannot be cast to")
            else:
                dtype = source_type(c.type, c.precision, c.scale)
        except UnresolvedTypeError as exc:
            errors.append(str(exc))
            continue
        out.append((name, dtype))
    if errors:
        raise UnresolvedTypeError(f"table {table}: " + "; ".join(errors))
    return out


def apply_types(df: DataFrame, resolved: list[tuple[str, T.DataType]], mode: str = "FAILFAST") -> DataFrame:
    """SEM-3: cast every resolved column in one select (``try_cast`` when permissive)."""
    types = {n.upper(): t for n, t in resolved}
    cols = []
    for c in df.columns:
        t = types.get(c.upper())
        if t is None:
            cols.append(F.col(c))
        elif mode == "PERMISSIVE":
            cols.append(F.col(c).try_cast(t).alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return df.select(*cols)
