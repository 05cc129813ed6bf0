"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


_SHIPPED: set[str] = set()


def visible(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package: by its path on the driver's host, and shipped with the job to other hosts."""
    context = spark.sparkContext
    env = context.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p]])
    if not context.master.startswith("local[") and context.applicationId not in _SHIPPED:
        context.addPyFile(packed())
        _SHIPPED.add(context.applicationId)
    return spark


def packed() -> str:
    """The package's modules as a zip file, for ``addPyFile``."""
    import tempfile
    import zipfile

    name = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(os.path.join(ROOT, name)):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), ROOT))
    return path


def local_session(cpus: int | str = 8, partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return visible(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
