"""Column encryption with AES-GCM, JVM-side (UDF-1..UDF-4).

An encrypted cell is ``struct<version:int, keyId:string, cipherText:string, iv:string>``
with base64 text. ``aes_encrypt`` draws a random 12-byte IV and prepends it;
the cell stores the two parts apart.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_DDL = "STRUCT<version: INT, keyId: STRING, cipherText: STRING, iv: STRING>"
IV_BYTES = 12


def protect_key(spark: SparkSession, key: str) -> None:
    """Hides a key's text and hex form in this session's plan texts."""
    have = spark.conf.get("spark.sql.redaction.string.regex", None)
    forms = [re.escape(key), key.encode().hex().upper(), key.encode().hex()]
    if have is None or forms[0] not in have:
        spark.conf.set("spark.sql.redaction.string.regex", "|".join(([have] if have else []) + forms))


def encrypt_value(c: Column, key: str, key_id: str, version: int = 1) -> Column:
    """One encrypted cell; NULL stays NULL.

    The cipher blob is bound once through a one-element ``transform`` so the IV
    and the cipher text are cut from the same encryption.
    """
    blob = F.aes_encrypt(c.cast("string").cast("binary"), F.lit(key), F.lit("GCM"))
    cell = F.transform(F.array(blob), lambda b: F.struct(
        F.lit(version).cast("int").alias("version"),
        F.lit(key_id).alias("keyId"),
        F.base64(F.substring(b, IV_BYTES + 1, 1 << 30)).alias("cipherText"),
        F.base64(F.substring(b, 1, IV_BYTES)).alias("iv"),
    ))[0]
    return F.when(c.isNull(), F.lit(None).cast(CELL_DDL)).otherwise(cell)


def decrypt_cell(cell: Column, key: str) -> Column:
    """UDF-1: decrypt one cell to text; NULL stays NULL."""
    blob = F.concat(F.unbase64(cell["iv"]), F.unbase64(cell["cipherText"]))
    return F.aes_decrypt(blob, F.lit(key), F.lit("GCM")).cast("string")


def decrypt_source(c: Column, key: str) -> Column:
    """UDF-2: decrypt a source value sent as base64(iv || cipher text || tag)."""
    return F.aes_decrypt(F.unbase64(c), F.lit(key), F.lit("GCM")).cast("string")


def encrypt_columns(df: DataFrame, columns: list[str], key: str, key_id: str, version: int = 1) -> DataFrame:
    """UDF-3: replace each listed column by its encrypted cell, in one select."""
    protect_key(df.sparkSession, key)
    wanted = {c.upper() for c in columns}
    return df.select(*[
        encrypt_value(F.col(c), key, key_id, version).alias(c) if c.upper() in wanted else F.col(c)
        for c in df.columns
    ])


def decrypt_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """UDF-4: replace each listed cell column by its plaintext, in one select."""
    protect_key(df.sparkSession, key)
    wanted = {c.upper() for c in columns}
    return df.select(*[
        decrypt_cell(F.col(c), key).alias(c) if c.upper() in wanted else F.col(c)
        for c in df.columns
    ])


def decrypt_source_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """UDF-2 over a column list: source-encrypted text to plaintext, in one select."""
    protect_key(df.sparkSession, key)
    wanted = {c.upper() for c in columns}
    return df.select(*[
        decrypt_source(F.col(c), key).alias(c) if c.upper() in wanted else F.col(c)
        for c in df.columns
    ])


def register_sql_functions(spark: SparkSession) -> None:
    """Register the decrypt functions for SQL text as SQL functions (no Python
    UDF). The key is an argument, never part of a function definition; pass it
    through a parameter marker, e.g.
    ``spark.sql("SELECT decrypt_target_cell(c, :key) FROM t", args={"key": key})``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION decrypt_target_cell(cell {CELL_DDL}, k STRING) RETURNS STRING "
        "RETURN CAST(aes_decrypt(concat(unbase64(cell.iv), unbase64(cell.cipherText)), k, 'GCM') AS STRING)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION decrypt_source_value(v STRING, k STRING) RETURNS STRING "
        "RETURN CAST(aes_decrypt(unbase64(v), k, 'GCM') AS STRING)"
    )
