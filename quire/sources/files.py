"""Document files and object-store keys (S1-S4, S7) and the sinks.

The reference walks a folder, uploads file by file and lists keys page by page; here the file listing is a
``binaryFile`` scan, keys are column expressions, and the sinks are DataFrame writers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted document extensions.
SUPPORTED_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".tif")
DEFAULT_PREFIX = "idp/raw/"
# Configured storage layers (written by S11, never read back by the flow).
LAYERS = ("raw", "classified", "extracted", "enriched", "reviewed", "output")


def file_name(path: Column) -> Column:
    """Last path component (a trailing '/' is ignored, like a path object's name)."""
    return F.regexp_extract(path, r"([^/\\]*)[/\\]*$", 1)


def suffix(name: Column) -> Column:
    """Extension of a file name, dot included, lower-cased: '' for 'a', '.a' and 'a.'."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def normalise_prefix(prefix: str) -> str:
    """Exactly one trailing '/': '' -> '/', 'a' -> 'a/', 'a//' -> 'a/'."""
    return prefix.rstrip("/") + "/"


def scan_documents(spark: SparkSession, directory: str, exts: Sequence[str] = SUPPORTED_EXTENSIONS) -> DataFrame:
    """Recursive listing of document files with an allowed (case-insensitive) extension.

    ``binaryFile`` with ``recursiveFileLookup``; ``pathGlobFilter`` is case-sensitive so the extension test is a
    column filter; unreadable files are skipped (``ignoreCorruptFiles``). Content is read lazily by Spark only
    if a later step selects it.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("ignoreCorruptFiles", "true").load(directory))
    ext = suffix(file_name(F.col("path")))
    return df.withColumn("ext", ext).where(F.col("ext").isin(list(exts)))


def plan_upload(files: DataFrame, bucket: str, prefix: str = DEFAULT_PREFIX, root: str | None = None,
                exts: Sequence[str] = SUPPORTED_EXTENSIONS, path_col: str = "path") -> DataFrame:
    """Object key for each file: normalised prefix + path relative to ``root`` (``\\`` -> ``/``), or the
    base name when no root is given (single-file upload). Unsupported extensions get an error instead of a key.

    Adds ``ext, key, uri, error``; ``key_collisions`` reports keys claimed by more than one file.
    """
    p = F.col(path_col)
    ext = suffix(file_name(p))
    if root is None:
        rel = file_name(p)
    else:
        r = root.rstrip("/\\")
        rel = F.when(p.startswith(r + "/") | p.startswith(r + "\\"), F.substring(p, len(r) + 2, 1 << 30)).otherwise(p)
    key = F.concat(F.lit(normalise_prefix(prefix)), F.regexp_replace(rel, r"\\", "/"))
    ok = ext.isin(list(exts))
    return files.select(
        "*", ext.alias("ext"),
        F.when(ok, key).alias("key"),
        F.when(ok, F.concat(F.lit(f"s3://{bucket}/"), key)).alias("uri"),
        F.when(~ok, F.concat(F.lit("Unsupported file format '"), ext, F.lit("'"))).alias("error"))


def key_collisions(planned: DataFrame) -> DataFrame:
    """Keys that more than one file maps to (flat base-name keys can collide)."""
    return planned.where(F.col("key").isNotNull()).groupBy("key").count().where(F.col("count") > 1)


def list_documents(manifest: DataFrame, prefix: str | None = None, default_prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """S3: keys under ``prefix`` (empty or None -> the default prefix); the whole listing, not one page."""
    pre = prefix or default_prefix
    return manifest.where(F.col("key").startswith(pre))


def resolve_input(df: DataFrame, default_bucket: str, content_col: str = "content", key_col: str = "key",
                  bucket_col: str | None = None) -> DataFrame:
    """Bytes win over a key; neither -> error. A missing bucket falls back to the default."""
    bucket = F.coalesce(F.col(bucket_col), F.lit(default_bucket)) if bucket_col else F.lit(default_bucket)
    has_bytes = F.col(content_col).isNotNull()
    has_key = F.col(key_col).isNotNull()
    return df.select(
        "*",
        F.when(has_bytes, F.lit("bytes")).when(has_key, F.lit("s3")).alias("input_kind"),
        F.when(~has_bytes & has_key, F.concat(F.lit("s3://"), bucket, F.lit("/"), F.col(key_col))).alias("input_uri"),
        F.when(~has_bytes & ~has_key, F.lit("Provide either s3_key or image_bytes")).alias("error"))


def wrap_text(df: DataFrame, text_col: str = "text", source: Column | None = None) -> DataFrame:
    """Text plus ``metadata{source}``; source defaults to 'document'."""
    src = source if source is not None else F.lit("document")
    return df.select("*", F.struct(src.alias("source")).alias("metadata"))


# ---------------------------------------------------------------- sinks

def write_training_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Columns ``label,text``, every field quoted, no header; quotes escaped by doubling."""
    (df.select(F.col("label").cast("string"), "text").write.mode(mode)
     .option("quoteAll", True).option("header", False).option("escape", '"').csv(path))


def write_entity_list_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header ``Text,Type``, every field quoted."""
    (df.select(F.col("text").alias("Text"), F.col("type").alias("Type")).write.mode(mode)
     .option("quoteAll", True).option("header", True).option("escape", '"').csv(path))


def write_results_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The typed result rows as JSON lines (read back with an explicit schema)."""
    df.write.mode(mode).json(path)


def _layer_path(base: str, layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}; expected one of {LAYERS}")
    return f"{base.rstrip('/')}/{layer}"


def write_layers(df: DataFrame, base: str, layer: str, partition_col: str = "document_type") -> str:
    """One configured layer as parquet partitioned by document type; returns the layer path.

    Writing again replaces the types that occur in ``df`` and leaves the others as they are (dynamic partition overwrite), so one
    class can be run again, and a repeated write does not duplicate rows.
    """
    out = _layer_path(base, layer)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(out)
    return out


def read_layer(spark, base: str, layer: str, types: Sequence[str] | None = None, partition_col: str = "document_type") -> DataFrame:
    """A layer, or the given document types of it; only their folders are listed and read."""
    df = spark.read.parquet(_layer_path(base, layer))
    return df if types is None else df.where(F.col(partition_col).isin(list(types)))
