"""Landed API pages: nested JSON in, flat rows of two families out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.schemas import PAGE

REGION_ROWS = "region"
FUEL_TYPE_ROWS = "fuel_type"


def read_pages(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Pages as stored, one JSON document per file, or one per line."""
    return (
        spark.read.schema(PAGE)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
        .select("response", F.col("_metadata.file_path").alias("__source_url"))
    )


def page_rows(pages: DataFrame, row_kind: str) -> DataFrame:
    """Rows of the pages, tagged with their family; a page without rows is an error."""
    data = (
        F.when(
            F.col("response").isNull(),
            F.raise_error(F.lit("page is missing the response object")),
        )
        .when(
            F.col("response.data").isNull(),
            F.raise_error(F.lit("page is missing response.data")),
        )
        .otherwise(F.col("response.data"))
    )
    return pages.select(F.explode(data).alias("row"), "__source_url").select(
        "row.*", F.lit(row_kind).alias("__row_kind"), "__source_url"
    )


def read_families(
    spark: SparkSession, region_path: str, fuel_type_path: str, *, multi_line: bool = True
) -> DataFrame:
    """Both families of one extract as one frame."""
    region = page_rows(read_pages(spark, region_path, multi_line=multi_line), REGION_ROWS)
    fuel = page_rows(read_pages(spark, fuel_type_path, multi_line=multi_line), FUEL_TYPE_ROWS)
    return region.unionByName(fuel)
