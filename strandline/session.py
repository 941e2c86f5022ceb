"""Session settings and the shared scratch folder."""

from __future__ import annotations

import importlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[tuple[str, str]] = set()


def build_session(app_name: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job relies on; extra conf wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_code(spark)
    return spark


def ship_code(spark: SparkSession, *packages: str) -> None:
    """Send packages of this repository to the executors, once per application."""
    app = spark.sparkContext.applicationId
    wanted = [p for p in packages or ("strandline",) if (app, p) not in _SHIPPED]
    if not wanted:
        return
    target = Path(tempfile.mkdtemp(prefix="strandline-code-")) / f"{'_'.join(wanted)}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for package in wanted:
            folder = Path(importlib.import_module(package).__file__).parent
            for source in sorted(folder.rglob("*.py")):
                archive.write(source, source.relative_to(folder.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.update((app, p) for p in wanted)


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables; it can go once the application has ended.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    session whose executor is the driver's own process falls back to a temporary folder.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/strandline-{app}"
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="strandline-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that no other call returns."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage and fixes values that a second evaluation could place in
    other partitions; the table outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Free the space of a scratch table that nothing reads any more, by overwriting it with no rows."""
    spark.range(0).write.mode("overwrite").parquet(path)
