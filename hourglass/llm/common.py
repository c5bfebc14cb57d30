"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import ensure_checkpoint_dir, ship_package

LONG_MAX = (1 << 63) - 1


def prepare(df: DataFrame) -> SparkSession:
    """Session of ``df``, with the package shipped to its Python workers."""
    spark = df.sparkSession
    ship_package(spark)
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back
    (cuts lineage; survives lost executors; compressed, unlike a checkpoint)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a stored table that a later one has replaced."""
    from pyarrow import fs as pafs

    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        store_fs, path = pafs.FileSystem.from_uri(folder)
        if store_fs.get_file_info(path).type == pafs.FileType.Directory:
            store_fs.delete_dir(path)


def order_key(id_col: str = "doc_id"):
    """Id as a non-null long that sorts missing ids last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MAX))


def whole_row(df: DataFrame, name: str = "_row"):
    """All columns as one struct: columns added next to it cannot clash, and
    ``select("_row.*")`` gives the rows back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
