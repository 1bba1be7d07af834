"""File readers and writers (SRC-1..11).

CSV/TSV are read with an explicit schema (no inference: zip prefixes keep
their leading zeros), tolerant quoting for free-text review comments, and
empty fields as NULL. Tables are loaded by ``sources.lake``; the audit column
is added only at write time so it never enters a comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every header (SRC-3)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _tidy(header: str) -> str:
    return header.lstrip("\ufeff").strip().lower()


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             multiline: bool = True, rejected: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (SRC-1, SRC-3, SRC-4), columns taken by *name*.

    Headers are tidied (byte-order mark, blanks, case) and may come in any order; a missing
    column is an error, further ones are ignored. A row that does not fit the schema stops
    the read, or, with ``rejected``, is kept with NULLs and its raw line in the column of that
    name, to be counted by :func:`rejected_rows`.

    ``multiLine`` is required for quoted free text with line breaks; such
    files are not splittable, so a huge source should be split into many
    files upstream (Spark then reads them in parallel).
    """
    options = {"header": True, "columnPruning": False, "sep": sep, "multiLine": multiline, "escape": '"', "nullValue": "",
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    headers = [_tidy(c) for c in spark.read.options(**options).csv(path).columns]  # reads the first line
    missing = [f.name for f in schema.fields if f.name not in headers]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} among {', '.join(headers)}")
    kinds = {f.name: f.dataType for f in schema.fields}
    raw = T.StructType([T.StructField(f"_{k}", kinds.get(h, T.StringType())) for k, h in enumerate(headers)]
                       + ([T.StructField("_rejected", T.StringType())] if rejected else []))
    df = (spark.read.schema(raw).options(**options)
          .option("mode", "PERMISSIVE" if rejected else "FAILFAST")
          .option("columnNameOfCorruptRecord", "_rejected").csv(path))
    kept = [F.col(f"_{headers.index(f.name)}").alias(f.name) for f in schema.fields]
    return df.select(*kept, *([F.col("_rejected").alias(rejected)] if rejected else []))


def rejected_rows(df: DataFrame, rejected: str, table: str) -> DataFrame:
    """Data-quality row (table_name, n_rows, n_rejected) of a frame read with ``rejected``."""
    # Spark reads the raw line only along with data columns
    data = F.concat_ws("", *[F.col(c).cast("string") for c in df.columns if c != rejected])
    return df.select(F.col(rejected).alias("_r"), F.length(data).alias("_n")) \
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_r").isNotNull() & (F.col("_n") >= 0)).alias("n_rejected")) \
        .select(F.lit(table).alias("table_name"), "n_rows", "n_rejected")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType,
             multiline: bool = False) -> DataFrame:
    """Tab-separated export with header (SRC-2); CRLF line ends are accepted.
    Single-line by default (splittable); set ``multiline`` for quoted line breaks."""
    return read_csv(spark, path, schema, sep="\t", multiline=multiline)


def with_audit(df: DataFrame, name: str = "dwh_create_date") -> DataFrame:
    """Load-time audit column (SRC-9); non-deterministic, add only when writing."""
    return df.withColumn(name, F.current_timestamp())


def write_tsv(df: DataFrame, path: str) -> None:
    """Mart export as TSV with header (SRC-10). Written by the executors in
    parallel (one file per partition), never funnelled through the driver."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               batchsize: int = 10000) -> None:
    """Batched parameterised insert into an RDBMS (SRC-7). Untested here: no
    JDBC driver or server is available in this environment."""
    (df.write.mode("overwrite").option("batchsize", batchsize)
     .jdbc(url, table, properties=properties))


def any_null(cols: list[str]):
    """Predicate: any of ``cols`` is NULL (FIL-1)."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
