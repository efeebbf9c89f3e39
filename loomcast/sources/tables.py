"""Sources and sinks: catalog and Parquet scans, partitioned and managed writes, CSV, local rows, scalars."""

from __future__ import annotations

import base64
import html
import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VALIDATION_SCHEMA = T.StructType([
    T.StructField("semaine", T.StringType()), T.StructField("code_agence", T.LongType()), T.StructField("code_article", T.LongType()), T.StructField("quantite", T.LongType()),
    T.StructField("p_zero", T.DoubleType()), T.StructField("qty_pred", T.DoubleType()), T.StructField("prediction", T.DoubleType()),
])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """``catalog.schema.table`` or a view."""
    return spark.read.table(name)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One file for each task and value; repartition by ``by`` first where that makes too many."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: its plan, cached blocks and broadcast tables weigh on nothing that follows.

    Where no such folder is set, local masters use a temporary one of this machine; any other master raises.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomcast-"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/loomcast/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str, properties: dict[str, str] | None = None) -> None:
    """Managed table, replaced with its schema; ``properties`` become table properties."""
    df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet").saveAsTable(name)
    if properties:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Moves a written folder to ``target``, in place of what is there."""
    new, files = _file_system(spark, source)
    old, _ = _file_system(spark, target)
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False if it is there already. Of several callers one succeeds."""
    where, files = _file_system(spark, path)
    try:
        return files.createNewFile(where)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise


def local_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """CSV with a header. ``one_file`` is for reports of bounded size."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def csv_text(df: DataFrame, most: int = 1_000_000) -> str:
    """A bounded result as the text of a CSV file, for a download; raises beyond ``most`` rows."""
    return small_pandas(df, most).to_csv(index=False)


def download_link(df: DataFrame, file_name: str, most: int = 1_000_000) -> str:
    """An HTML link that holds the CSV itself."""
    data = base64.b64encode(csv_text(df, most).encode()).decode()
    return f'<a download="{html.escape(file_name, quote=True)}" href="data:text/csv;base64,{data}">{html.escape(file_name)}</a>'


def scalar(df: DataFrame):
    """The first column of the first row; None if there is none."""
    row = df.first()
    return None if row is None else row[0]


def small_pandas(df: DataFrame, most: int = 100_000):
    """A bounded result as pandas; raises instead of fetching more than ``most`` rows."""
    found = df.limit(most + 1).toPandas()
    if len(found) > most:
        raise ValueError(f"more than {most} rows; aggregate first")
    return found
