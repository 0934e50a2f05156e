"""Session defaults, and shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def session(app: str = "helixframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow and UTC; conf overrides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Makes the package importable by the session's Python workers, once a session."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp()) / "helixframe.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset."""
    import uuid

    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a Parquet table at path: what several plans read is made once, and a lost executor doesn't lose it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
