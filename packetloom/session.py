"""Session settings and the folder that all executors share."""

import tempfile
import uuid
import zipfile
from pathlib import Path

# Adaptive execution re-plans joins from measured sizes and splits skewed
# partitions; everything else is left at Spark's defaults.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(builder, **extra):
    """Apply the recommended settings to a ``SparkSession.builder``."""
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark):
    """Folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only a local master may
    fall back to a temporary folder, which is then set for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="packetloom-")
    spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark, name):
    """A fresh sub-folder of the shared folder for one run's tables."""
    return f"{shared_folder(spark)}/packetloom/{name}-{uuid.uuid4().hex}"


def ship(spark):
    """Send this package to the executors, once a session.

    Functions that run on executors are found there by import, so the package
    must be there too, wherever the driver was started.
    """
    context = spark.sparkContext
    if getattr(context, "_packetloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="packetloom-ship-")) / "packetloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._packetloom_shipped = True
