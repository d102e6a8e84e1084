"""File sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pdf_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Id (SHA-256 of the path), path, name, size and digest of every PDF of a folder, or of one file; in order of the paths.

    A PDF is known by its first bytes. Of files with one name the last path counts. A single file of another kind is an
    error, and so is a folder without any PDF.
    """
    if re.search(r"\.\w+$", path.rstrip("/").rsplit("/", 1)[-1]) and not path.lower().endswith(".pdf"):
        raise ValueError(f"{path} is no PDF")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", str(recursive).lower()).load(path)
    rows = files.filter((F.col("length") > 0) & (F.substring("content", 1, 5) == F.lit(b"%PDF-")))
    named = rows.select(F.sha2("path", 256).alias("id"), "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", F.sha2("content", 256).alias("digest"))
    if named.isEmpty():
        raise FileNotFoundError(f"no PDF in {path}")
    return named.groupBy("name").agg(F.max(F.struct("path", "id", "length", "digest")).alias("f")).select("name", "f.*").orderBy("path")


def rejected_files(spark: SparkSession, path: str) -> DataFrame:
    """Files named as PDFs that don't begin as one; files without any byte are passed over by the scan and come out nowhere."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "true").load(path)
    return files.filter(F.coalesce(F.substring("content", 1, 5) != F.lit(b"%PDF-"), F.lit(True))).select("path", F.lit("not_a_pdf").alias("reason"))


def json_results(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Result files, one object or a list of them each; unreadable ones are left out."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.extracted.json").json(folder)


def split_valid(records: DataFrame, errors: DataFrame, key: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """Records without and with errors; the latter go to quarantine with their messages."""
    both = records.join(errors.select(key, "errors").distinct(), key, "left")
    bad = F.coalesce(F.col("errors"), F.lit("")) != ""
    return both.filter(~bad).drop("errors"), both.filter(bad)


def write_json(df: DataFrame, path: str, *by: str) -> None:
    """Rows as JSON, in folders by the given columns; Spark's commit leaves either all of it or nothing."""
    df.write.mode("overwrite").partitionBy(*by).json(path) if by else df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Rows as CSV with a header; ``one_file`` is for reports of a bounded number of rows."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def save_checked(records: DataFrame, errors: DataFrame, path: str, key: str = "record_id") -> tuple[str, str]:
    """Valid records to ``<path>/valid``, the others with their errors and status to ``<path>/failed``."""
    good, bad = split_valid(records, errors, key)
    write_json(good, f"{path}/valid")
    write_json(bad.withColumn("status", F.lit("failed_schema_validation")), f"{path}/failed")
    return f"{path}/valid", f"{path}/failed"


def cached(inputs: DataFrame, cache: DataFrame, digest: str = "digest") -> tuple[DataFrame, DataFrame]:
    """Inputs that the cache has by their content, with what it has, and those that are still to be made."""
    kept = cache.dropDuplicates([digest])
    return inputs.join(kept, digest), inputs.join(kept.select(digest), digest, "left_anti")


def canonical(df: DataFrame, key: str) -> DataFrame:
    """Each row as JSON with its fields in order of their names, and the SHA-256 of that text as its id."""
    content = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return df.select(F.col(key).alias("key"), content.alias("content")).withColumn("id", F.sha2("content", 256))


def response_log(responses: DataFrame, text: str = "raw", most: int = 500) -> DataFrame:
    """What is logged of an answer: its beginning, its length and its SHA-256."""
    kept = [c for c in responses.columns if c != text]
    return responses.select(*kept, F.substring(text, 1, most).alias("preview"), F.length(text).alias("n_chars"), F.sha2(text, 256).alias("sha256"))
