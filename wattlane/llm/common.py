"""What several operators share: the word pattern, document keys and short-lived tables."""

from __future__ import annotations

import atexit
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.session import shared_folder

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_aside(rows: DataFrame) -> DataFrame:
    """The rows, computed once and read again from the folder that all executors share."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


_WRITTEN: list[tuple[SparkSession, str]] = []


def written(rows: DataFrame) -> DataFrame:
    """The rows, written once as Parquet into the folder that all executors share.

    Unlike a checkpoint, columns that a reader does not ask for are not read. The folder
    goes when the process that asked for it ends.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_clear_written)
    _WRITTEN.append((spark, path))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _clear_written() -> None:
    for spark, path in _WRITTEN:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session is gone already
            return


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``text_key``; no other column comes along.

    Id and ``text_key`` name a document: rows that agree in both are copies of one
    document and get the same answer, rows of one id with unlike texts do not mix.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key")
    )


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def with_text(docs: DataFrame, text: Column, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with another text and, where there is one, its ``n_chars``."""
    columns = []
    for name in like.columns:
        if name == "text":
            columns.append(text.alias(name))
        elif name == "n_chars":
            columns.append(F.char_length(text).cast(like.schema[name].dataType).alias(name))
        else:
            columns.append(docs[f"`{name}`"])
    return docs.select(*columns)
