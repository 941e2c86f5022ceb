"""File manifests: which files there are, how big, and which of them to take."""

from __future__ import annotations

from urllib.parse import urlparse

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.columns import any_match

# Fixed value: the suffix of the files a shapefile job looks for, case-sensitive.
SHAPE_SUFFIX = ".shp"


def list_files(spark: SparkSession, directory: str, suffix: str = SHAPE_SUFFIX, recursive: bool = False) -> DataFrame:
    """(path, file_name, size_bytes) of a directory's files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(directory).select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("size_bytes"))


def file_select_contains(files: DataFrame, selectors: list[str] | None, name: str = "file_name") -> DataFrame:
    """Files whose name, extension included, contains any selector; none given keeps all."""
    return files.where(any_match(F.col(name), selectors))


def file_select_prefix(files: DataFrame, selectors: list[str] | None, name: str = "file_name") -> DataFrame:
    """Files whose name starts with any selector; none given keeps all."""
    return files.where(any_match(F.col(name), selectors, "prefix"))


def stem(col):
    """File name without directories and extension."""
    return F.regexp_extract(col, r"([^/]+?)(?:\.[^./]*)?$", 1)


def plain_path(path):
    """A file's path as listings have it, from the escaped URI in ``_metadata.file_path``."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def object_store_options(url: str) -> tuple[str, dict[str, str]]:
    """s3a path and options for anonymous reading of ``https://endpoint/bucket/key``; other paths as they are."""
    parts = urlparse(url)
    if parts.scheme == "s3":
        return "s3a" + url[len("s3"):], {}
    if parts.scheme not in ("http", "https"):
        return url, {}
    bucket = parts.path.lstrip("/").split("/", 1)[0]
    prefix = f"fs.s3a.bucket.{bucket}."
    return f"s3a://{parts.path.lstrip('/')}", {
        prefix + "endpoint": f"https://{parts.netloc}",
        prefix + "path.style.access": "true",
        prefix + "aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
    }


def resolve(path: str, options: dict[str, str] | None = None) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI as Spark writes it; usable inside tasks.

    ``options`` are those of ``object_store_options``: an endpoint is read without credentials.
    """
    endpoint = next((v for k, v in (options or {}).items() if k.endswith(".endpoint")), None)
    if endpoint and path.startswith("s3a://"):
        return pafs.S3FileSystem(anonymous=True, endpoint_override=endpoint), path[len("s3a://"):]
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)
