"""A census of papers: rows that can be processed, and typed exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import slug

#: Columns that a census must have, and what a derived id may look like.
REQUIRED = ("paper_id", "year", "venue", "title", "pdf_url")
PAPER_ID = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def read_census(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, one line for each paper, in file order (column line)."""
    df = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    missing = sorted(set(REQUIRED) - set(df.columns))
    if missing:
        raise ValueError(f"census is missing required columns: {missing}")
    return df.withColumn("line", F.monotonically_increasing_id())


def judge_census(df: DataFrame) -> DataFrame:
    """df(paper_id, year, pdf_url, line, ...) with slug and reason: why the row is excluded, null for one that can be processed.

    First match: no id, an id seen before, no address, an address that is not http, an unusable id, an id whose slug an earlier usable row
    has, an unreadable year. Null counts as empty; lines order rows that share an id or a slug.
    """
    own = df.withColumn("paper_id", F.trim(F.coalesce("paper_id", F.lit("")))).withColumn("pdf_url", F.trim(F.coalesce("pdf_url", F.lit(""))))
    own = own.withColumn("slug", slug(F.col("paper_id")))
    first = (F.col("paper_id") != "") & (F.row_number().over(Window.partitionBy("paper_id").orderBy("line")) == 1)
    own = own.withColumn("_first", first)
    early = (
        F.when(F.col("paper_id") == "", "missing_paper_id")
        .when(~F.col("_first"), "duplicate_census_paper_id")
        .when(F.col("pdf_url") == "", "missing_pdf_url")
        .when(~F.regexp_like("pdf_url", F.lit("(?i)^https?://")), "pdf_url_not_absolute_http")
        .when(~F.regexp_like("slug", F.lit(PAPER_ID)), "unusable_paper_id")
    )
    own = own.withColumn("_early", early)
    # Rows that fall out before do not take a slug.
    place = F.row_number().over(Window.partitionBy("slug", F.col("_early").isNull()).orderBy("line"))
    own = own.withColumn("_place", place)
    late = F.when(F.col("_place") > 1, "duplicate_derived_paper_id").when(F.trim(F.coalesce("year", F.lit(""))).try_cast("int").isNull(), "unreadable_year")
    return own.withColumn("reason", F.coalesce("_early", late)).drop("_first", "_early", "_place")
