"""Publishing to a relational database over JDBC (SNK-12..15, JON-3, SRC-13).

Bulk rows go through Spark's JDBC writer from the executors; only DDL and the
final ``MERGE`` statement run on the driver's connection, once per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL column types used for Spark types on the database side.
SQL_TYPES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INT",
    T.ShortType: "SMALLINT",
    T.ByteType: "SMALLINT",
    T.StringType: "NVARCHAR(MAX)",
    T.TimestampType: "DATETIME2",
    T.TimestampNTZType: "DATETIME2",
    T.DateType: "DATE",
    T.DoubleType: "FLOAT",
    T.FloatType: "REAL",
    T.BooleanType: "BIT",
    T.BinaryType: "VARBINARY(MAX)",
}


def quoted(name: str) -> str:
    """An identifier as the database reads it, whatever characters it has."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which every database can hold."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    return df.select(*[F.to_json(c).alias(c) if c in nested else F.col(f"`{c}`") for c in df.columns])


def sql_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    for k, v in SQL_TYPES.items():
        if isinstance(dtype, k):
            return v
    raise ValueError(f"no SQL type for {dtype.simpleString()}")


def create_schema_sql(schema: str) -> str:
    return f"CREATE SCHEMA {quoted(schema)}"


def create_table_sql(table: str, schema: T.StructType) -> str:
    cols = ", ".join(f"{quoted(f.name)} {sql_type(f.dataType)}" for f in schema.fields)
    return f"CREATE TABLE {quoted(table)} ({cols})"


def add_columns_sql(table: str, existing: list[str], schema: T.StructType) -> list[str]:
    """SNK-15: one ``ALTER TABLE ADD`` per column the table lacks (case-insensitive)."""
    have = {c.upper() for c in existing}
    return [f"ALTER TABLE {quoted(table)} ADD {quoted(f.name)} {sql_type(f.dataType)}"
            for f in schema.fields if f.name.upper() not in have]


def merge_sql(target: str, staging: str, columns: list[str], keys: list[str],
              seq: str | None = "_changeSequence") -> str:
    """JON-3: MERGE staging into target on the keys; a matched row is updated
    only when the staged sequence is newer, so replays change nothing."""
    q = {c: quoted(c) for c in [*columns, *keys]}
    # A NULL key is one key, so a replay finds its row again.
    on = " AND ".join(f"(t.{q[k]} = s.{q[k]} OR (t.{q[k]} IS NULL AND s.{q[k]} IS NULL))" for k in keys)
    sets = ", ".join(f"{q[c]} = s.{q[c]}" for c in columns if c not in keys)
    guard = f" AND s.{quoted(seq)} > t.{quoted(seq)}" if seq and seq in columns else ""
    cols = ", ".join(q[c] for c in columns)
    vals = ", ".join(f"s.{q[c]}" for c in columns)
    return (f"MERGE INTO {quoted(target)} t USING {quoted(staging)} s ON {on} "
            f"WHEN MATCHED{guard} THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals});")


def _connection(spark: SparkSession, url: str, props: dict):
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def execute(spark: SparkSession, url: str, props: dict, statements: list[str]) -> None:
    conn = _connection(spark, url, props)
    try:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
    finally:
        conn.close()


def table_columns(spark: SparkSession, url: str, props: dict, schema: str, table: str) -> list[str] | None:
    """SRC-13: the table's columns, or None when it does not exist."""
    conn = _connection(spark, url, props)
    try:
        rs = conn.getMetaData().getColumns(None, schema.upper(), table.upper(), None)
        cols = []
        while rs.next():
            cols.append(rs.getString("COLUMN_NAME"))
        rs.close()
        return cols or None
    finally:
        conn.close()


def schema_exists(spark: SparkSession, url: str, props: dict, schema: str) -> bool:
    conn = _connection(spark, url, props)
    try:
        rs = conn.getMetaData().getSchemas()
        found = False
        while rs.next():
            found = found or rs.getString(1).upper() == schema.upper()
        rs.close()
        return found
    finally:
        conn.close()


def publish_jdbc(spark: SparkSession, staged: DataFrame, url: str, props: dict, schema: str, table: str,
                 staging_schema: str, keys: list[str], partitions: int) -> None:
    """SEM-15 database side: create schemas and tables if missing, add new
    columns, overwrite the staging table with ``partitions`` writers, MERGE."""
    target, staging, staged = f"{schema}.{table}", f"{staging_schema}.{table}", flat(staged)
    ddl = []
    for s in (schema, staging_schema):
        if not schema_exists(spark, url, props, s):
            ddl.append(create_schema_sql(s))
    execute(spark, url, props, ddl)
    ddl = []
    for s, t in ((schema, target), (staging_schema, staging)):
        cols = table_columns(spark, url, props, s, table)
        ddl.extend([create_table_sql(t, staged.schema)] if cols is None else add_columns_sql(t, cols, staged.schema))
    execute(spark, url, props, ddl)
    if staged.isEmpty():
        return
    # The staging table is there by now, with this module's column types, and is emptied, not made anew.
    staged.repartition(partitions).write.mode("overwrite").option("truncate", "true").jdbc(url, staging, properties=props)
    execute(spark, url, props, [merge_sql(target, staging, staged.columns, keys)])
