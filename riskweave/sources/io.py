"""Sources and sinks S1-S5: CSV with pandas-style missing tokens, stage
checkpoints as Parquet, feature lists as ordered tables.

Stage outputs go to the shared folder named by ``spark.checkpoint.dir``
(``riskweave.session.scratch_path``), never to a machine-local folder, so
a lost executor's work is re-read, not recomputed from the start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.scalar import missing_tokens_to_null


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan. With a schema, strings are read as such and every
    pandas missing token ("", NA, NaN, null, None, ...) becomes NULL before
    the cast, since ``nullValue`` takes one token only."""
    if schema is None:
        return spark.read.option("header", header).option("inferSchema", True).csv(path)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    raw_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields])
    raw = spark.read.option("header", header).schema(raw_schema).csv(path)
    return raw.select(*[missing_tokens_to_null(F.col(f.name)).try_cast(f.dataType).alias(f.name)
                        if not isinstance(f.dataType, T.StringType)
                        else missing_tokens_to_null(F.col(f.name)).alias(f.name)
                        for f in st.fields])


RECORD, BAD = "record", "bad_columns"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV whose records need not fit the schema.

    A record is rejected as a whole if a value that is not a missing token does
    not cast to its type (``bad_columns`` names these), or if it has more or
    fewer fields than the schema (``bad_columns`` is empty). Rejects keep the
    record as it stood in the file; nothing turns into NULL unnoticed. Both
    frames read the files once each and only what they show.
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    raw_schema = T.StructType([*(T.StructField(f.name, T.StringType(), True) for f in st.fields), T.StructField(RECORD, T.StringType(), True)])
    raw = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
           .option("enforceSchema", True).schema(raw_schema).csv(path))
    texts = {f.name: missing_tokens_to_null(F.col(f"`{f.name}`")) for f in st.fields}
    typed = {f.name: texts[f.name] if isinstance(f.dataType, T.StringType) else texts[f.name].try_cast(f.dataType) for f in st.fields}
    bad = F.filter(F.array(*(F.when(texts[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in texts)), lambda n: n.isNotNull())
    marked = raw.withColumn(BAD, bad)
    fits = F.col(RECORD).isNull() & (F.size(BAD) == 0)
    rows = marked.where(fits).select(*(c.alias(n) for n, c in typed.items()))
    quoted = F.concat_ws(",", *(F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in st.fields))
    rejects = marked.where(~fits).select(F.coalesce(RECORD, quoted).alias(RECORD),
                                         F.when(F.col(RECORD).isNotNull(), F.array().cast("array<string>")).otherwise(F.col(BAD)).alias(BAD))
    return rows, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected records by cause: a column's name, or ``fields`` for a wrong number of fields; one record may count for several."""
    causes = F.when(F.size(BAD) > 0, F.col(BAD)).otherwise(F.array(F.lit("fields")))
    return rejects.select(F.explode(causes).alias("cause")).groupBy("cause").agg(F.count(F.lit(1)).alias("records"))


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN (pandas' missing) -> NULL in every float / double column, once at
    ingest: a NaN left in makes max / avg / median return NaN and compares
    greater than every number."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not fl:
        return df
    return df.select(*[F.when(F.isnan(F.col(f"`{c}`")), F.lit(None).cast(t)).otherwise(F.col(f"`{c}`")).alias(c)
                       if c in fl else F.col(f"`{c}`") for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S3: stage checkpoint as Parquet (cuts lineage when re-read)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a saved stage."""
    return spark.read.parquet(path)


def checkpoint_stage(spark: SparkSession, df: DataFrame, path: str,
                     shapes: dict | None = None, name: str | None = None) -> DataFrame:
    """Write then re-read: the plan downstream starts from the files.

    With ``shapes``, ``shapes[name] = (rows, columns)`` (A24): the row count
    of the written Parquet files comes from their footers (row-group
    metadata), not from another pass over the data. (``Observation`` would
    count during the write, but in this Spark version a session that used one
    fails later writes with a non-serializable task.)"""
    write_stage(df, path)
    back = read_stage(spark, path)
    if shapes is not None:
        shapes[name or path] = (back.count(), len(back.columns))
    return back


def feature_list_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """An ordered feature list as a (pos, name) table."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, name string")


def save_feature_list(spark: SparkSession, names: Sequence[str], path: str) -> None:
    feature_list_frame(spark, names).coalesce(1).write.mode("overwrite").parquet(path)


def load_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r["name"] for r in spark.read.parquet(path).orderBy("pos").collect()]


def profile(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: bool = True) -> None:
    """Ingest once into a table bucketed (and sorted) by ``key``.

    Tables bucketed on the same key with the same bucket count are read
    co-partitioned: group-bys and joins on that key plan without an exchange
    (``spark.sql.sources.bucketing.enabled``). For the feature pipeline,
    bucket every child table of previous loans and the (client, loan) links by
    the loan id: level-1 aggregates and the link join then shuffle nothing.
    The table lives under ``spark.sql.warehouse.dir`` (shared storage on a
    cluster).
    """
    w = df.write.mode("overwrite").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)
