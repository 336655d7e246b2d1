"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "graustein", extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_CHECKPOINT: dict[int, str] = {}


def _context_conf(spark: SparkSession, key: str):
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system). Only when it
    is unset and the master is local (tests) a private temporary folder is created, once
    per session."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or _context_conf(spark, CHECKPOINT_CONF)
    if not path:
        master = spark.conf.get("spark.master", None) or _context_conf(spark, "spark.master") or ""
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        key = id(spark)
        path = _LOCAL_CHECKPOINT.get(key) or tempfile.mkdtemp(prefix="graustein-ckpt-")
        _LOCAL_CHECKPOINT[key] = path
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # some deployments reject setting core confs at runtime
            pass
    try:
        spark.sparkContext.setCheckpointDir(path)  # for DataFrame.checkpoint()
    except Exception:
        pass
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written intermediate tables)."""
    return os.path.join(checkpoint_dir(spark), *parts)


REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def arrow_stage(df, fn, schema: str):
    """``mapInArrow`` whose Python workers can import this package also when the driver process was
    started from another folder."""
    env = getattr(df.sparkSession.sparkContext, "environment", None)
    if env is not None and REPO not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)
    return df.mapInArrow(fn, schema)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run here are removed when each ends; else they stay until the
    driver happens to collect its garbage, those of a job's earlier writes beside those of the later ones."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)


def written_copy(df, name: str = "table", **options):
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    Used where one intermediate result feeds several outputs: it is computed once, its
    lineage is cut (a lost executor re-reads files instead of recomputing joins), and
    nothing goes through the driver."""
    return df.sparkSession.read.parquet(_write_copy(df, name, options))


def _write_copy(df, name: str, options: dict) -> str:
    import uuid
    path = scratch_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.mode("errorifexists").options(**options).parquet(path)
    return path


@contextmanager
def passing_copy(df, name: str = "table", **options) -> Iterator:
    """A ``written_copy`` for the tables that are written here; its files are removed behind them."""
    from graustein.sinks.commits import file_system
    path = _write_copy(df, name, options)
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        fs, folder = file_system(df.sparkSession, path)
        fs.delete(folder, True)
