"""Session settings every job relies on, and the cluster's shared scratch folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Results depend on these, so every session uses the same ones.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in {**REQUIRED_CONF, **ADAPTIVE_CONF}.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: what ``spark.checkpoint.dir`` or the context's checkpoint folder names.

    Only on one machine, where neither is set, a temporary folder stands in for it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = given.get() if given.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="sluice-shared-")
        folder = _LOCAL_FOLDERS[app]
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Drop a folder this package wrote itself (a finished staging area)."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def subfolders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below ``path``, as paths relative to it."""
    fs, hadoop_path = _file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    if depth == 1:
        return names
    return [f"{name}/{below}" for name in names for below in subfolders(spark, f"{path}/{name}", depth - 1)]


def replace_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Move ``source`` to where ``target`` is; true if ``target`` is new. Both on one file system."""
    fs, new = _file_system(spark, source)
    old = spark._jvm.org.apache.hadoop.fs.Path(target)
    existed = fs.exists(old)
    if existed:
        fs.delete(old, True)
    else:
        fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"could not move {source} to {target}")
    return not existed


_SHIPPED: set[tuple[str, Path]] = set()


def ship_package(spark: SparkSession, package: Path = Path(__file__).resolve().parent) -> None:
    """Send a Python package folder to the workers, once per application; by default this one.

    Needed only where it is not installed on the executors; ``--py-files`` does the same.
    """
    context = spark.sparkContext
    if (context.applicationId, package) in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp(prefix="sluice-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add((context.applicationId, package))
