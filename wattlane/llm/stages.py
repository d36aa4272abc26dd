"""Stages of the corpus pipeline: documents in, documents out, all but the last with the
columns they came with. Every stage judges what it is given, in every row."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm import golay_simhash, line_windows, mixing, ordinal, pieces
from wattlane.llm.common import read_table, same_document
from wattlane.llm.queries import PIECE_MODEL, tokenizer_path


def work_folder(shared: str) -> str:
    return f"{shared}/pipeline-{uuid4().hex}"


def _named(docs: DataFrame) -> DataFrame:
    """The documents with what names them, apart from their own columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("doc"), "doc_id", F.xxhash64(text).alias("text_key"))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely of the best grade, by the labels that name them."""
    labels = read_table(spark, sf_dir, "labels")
    ratings = labels.select(
        "doc_id", ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade")
    )
    model = ordinal.fitted(docs, ratings)
    # The text goes through Python once, apart from the other columns.
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("rest"), "text")
    found = ordinal.graded(rows, model, keep_text=True).where("kept")
    return found.select(*("text" if c == "text" else f"rest.`{c}`" for c in docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated three-line windows; those that lose all lines go."""
    rows = _named(docs)
    texts = rows.select("doc_id", "text_key", F.coalesce("doc.text", F.lit("")).alias("text"))
    gone = (
        line_windows.later_windows(line_windows.window_rows(texts))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("line").alias("starts"))
    )
    cut = line_windows.without_windows(
        rows.join(gone, same_document(rows, gone), "left").select("doc", "starts"), F.col("doc.text")
    )
    kept = F.when(F.size("removed") == 0, F.col("doc.text")).otherwise(F.col("kept_text"))
    emptied = (F.size("removed") > 0) & (F.length(F.trim("kept_text")) == 0)
    columns = []
    for field in docs.schema.fields:
        value = F.col(f"doc.`{field.name}`")
        if field.name == "text":
            value = kept
        elif field.name == "n_chars":
            value = F.when(F.size("removed") > 0, F.char_length(kept)).otherwise(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return cut.where(~emptied).select(*columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id, then of the
    smallest text key, then of the least other columns; a null id is the smallest."""
    rest = F.to_json(
        F.struct(F.lit(0).alias("none"), *(f"doc.`{c}`" for c in docs.columns if c not in ("doc_id", "text"))),
        {"ignoreNullFields": "false"},
    )
    rows = _named(docs).select("*", F.struct("doc_id", "text_key").alias("name"), rest.alias("rest"))
    # Id and text name a document, so unlike texts of one id stay apart.
    found = golay_simhash.near_dedup(
        rows.select("name", F.col("doc.text").alias("text")), id_col="name"
    )
    chosen = found.select("component_id.*").distinct()
    least = rows.groupBy("doc_id", "text_key").agg(F.min("rest").alias("rest"))
    chosen = least.join(chosen, same_document(least, chosen), "left_semi")
    one = same_document(rows, chosen) & (rows["rest"] == chosen["rest"])
    return rows.join(chosen, one, "left_semi").dropDuplicates(["doc_id", "text_key"]).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those taken no times go. Rows that agree in
    id, source and text are copies of one document and share what the mix takes of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mixed = mixing.mix(docs.withColumn("__text_key", F.xxhash64(text)), keep=["__text_key"])
    copies = mixed.groupBy("doc_id", F.col("__text_key").alias("text_key"), F.col("source").alias("of")).agg(
        F.sum("copies").alias("copies")
    )
    copies = copies.where(F.col("copies") > 0)
    rows = _named(docs).withColumn("of", F.col("doc.source")).dropDuplicates(["doc_id", "text_key", "of"])
    same = same_document(rows, copies) & rows["of"].eqNullSafe(copies["of"])
    taken = rows.join(copies, same).select("doc", "copies")
    return taken.select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, digests of ids and decoded text, and the ``ids``."""
    return pieces.encode_documents(docs, tokenizer_path(PIECE_MODEL), keep=["source"])
