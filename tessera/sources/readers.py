"""Document readers.  Explicit schemas; no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import strip as strip_space
from tessera.functions.text import strip_bom


def read_csv_docs(spark: SparkSession, path: str, text_index: int = 2, limit: int | None = None,
                  multi_line: bool = True) -> DataFrame:
    """A1: header row skipped, the column at ``text_index`` is the text.
    All columns are read as strings (no inference); ``limit`` keeps exactly
    ``limit`` rows (S17).  Texts with line breaks need ``multi_line``, which
    reads a file in one task; without them, switch it off and files are split."""
    df = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
          .option("inferSchema", False).csv(path))
    out = df.select(F.col(f"`{df.columns[text_index]}`").alias("text"))
    return out.limit(limit) if limit is not None else out


def read_lines(spark: SparkSession, path: str, limit: int | None = None, strip: bool = False) -> DataFrame:
    """A2/A5: one document (or sentence) per line."""
    df = spark.read.text(path)
    col = strip_space("value") if strip else F.col("value")
    out = df.select(col.alias("text"))
    return out.limit(limit) if limit is not None else out


def read_corpus_files(spark: SparkSession, root: str, name_pattern: str, groups: dict[str, int]) -> DataFrame:
    """A4: every file under ``root`` (recursively) is one document; the BOM is
    removed; metadata columns come from regex groups of the (URL-decoded)
    file path.  ``wholetext`` must be passed as a keyword: the option form is
    overridden by the keyword default."""
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    path = F.url_decode(F.col("_metadata.file_path"))
    cols = [F.regexp_extract(path, name_pattern, g).alias(n) for n, g in groups.items()]
    return df.select(*cols, path.alias("path"), strip_bom("value").alias("text"))


def read_shards(spark: SparkSession, prefix: str) -> DataFrame:
    """Sharded pre-tokenised sentence files ``prefix*.gz`` (gzip is
    decoded by the reader); one sentence per line, with the shard name."""
    df = spark.read.text(prefix + "*.gz")
    return df.select(F.col("_metadata.file_name").alias("shard"), F.col("value").alias("text"))


def read_docs(spark: SparkSession, path: str, fmt: str = "auto", limit: int | None = None) -> DataFrame:
    """A3: dispatch by format / extension."""
    kind = fmt if fmt != "auto" else ("csv" if path.endswith(".csv") else
                                      "parquet" if path.endswith(".parquet") else "text")
    if kind == "csv":
        return read_csv_docs(spark, path, limit=limit)
    if kind == "parquet":
        df = spark.read.parquet(path).select("text")
        return df.limit(limit) if limit is not None else df
    return read_lines(spark, path, limit)
