"""Session helpers: reading tables and cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loomgraph", cores: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with adaptive execution on, UTC, and Arrow transfer to Python.

    In local mode all tasks share the driver's memory: LOOMGRAPH_DRIVER_MEMORY, by default 12g.
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("LOOMGRAPH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give all Python workers this package, wherever the driver was started from. Done once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="loomgraph-")) / "loomgraph.zip"
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(made))  # the driver serves the file to the executors
    _shipped.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share for cut lineage.

    A folder that is set (``spark.checkpoint.dir`` or ``setCheckpointDir``) is used as it is. Only where none is
    set and the master is local, as in tests, a temporary folder is made; on a cluster that is an error.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="loomgraph-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from the written copy.

    Used where rows are read several times or an id must not change when a lost executor's work is redone. The
    tables of a session lie in one folder, which is removed when the driver ends; those written within ``scratch`` are
    removed with it.
    """
    spark = df.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/loomgraph-{spark.sparkContext.applicationId}"
    if base not in _made:
        _made.add(base)
        atexit.register(_remove, spark, base)
    path = f"{base}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


_made: set[str] = set()
_scopes: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``cut`` writes inside are removed at the end. Nothing that reads them may be used afterwards, so
    results are to be written or collected inside."""
    tables: list[tuple[SparkSession, str]] = []
    _scopes.append(tables)
    try:
        yield
    finally:
        _scopes.pop()
        for spark, path in tables:
            _remove(spark, path)


def _remove(spark: SparkSession, base: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass
