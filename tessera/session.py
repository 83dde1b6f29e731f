"""Session configuration, table loading and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings that matter at every scale: AQE re-plans joins and coalesces
# partitions at run time, skew-join splits hot shuffle partitions, and the
# session time zone is pinned so timestamps compare across engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),  # texts are long
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster, use the
    cluster's own builder and call :func:`configure` on it."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL settings that are safe to set on an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a shared session: leave it
                pass
    # Python workers import this package from where the driver did, also when
    # it isn't installed (a path that doesn't exist on a worker is ignored)
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: str | None = None


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, which all its machines share.
    Only a local master may leave it unset (tests): it then gets a scratch
    folder of this process. Anything else raises, since what executors write
    to their own disks others don't find."""
    global _LOCAL_CKPT
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        d = _LOCAL_CKPT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def written(spark: SparkSession, path: str) -> bool:
    """A write to ``path`` was completed (its success marker is there)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(p)


def tables_version(spark: SparkSession, sf_dir: str) -> str:
    """Name, length and time of what lies in ``sf_dir``: other input, other version."""
    fs, p = _fs(spark, sf_dir)
    return "|".join(sorted(f"{x.getPath().getName()}:{x.getLen()}:{x.getModificationTime()}" for x in fs.listStatus(p)))


def drop_state(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder behind a frame produced by :func:`cut_lineage`
    once nothing refers to it (superseded loop state)."""
    path = getattr(df, "_tessera_state_path", None)
    if path:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any
    more. It does so when the driver collects its garbage, which a loop of small
    plans over large tables may never bring about."""
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame, name: str = "state") -> DataFrame:
    """Cut lineage and plan: write ``df`` as Parquet under the shared
    checkpoint folder and read it back. Survives executor loss (unlike a
    local checkpoint), and the next round plans against a plain file scan:
    a ``checkpoint()``-ed frame keeps enough of its origin plan that an
    iterative loop's planning time grows round after round."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # a known schema costs no job
    out._tessera_state_path = path
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
