"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every hourglass job relies on. AQE re-plans joins at runtime from
# measured shuffle sizes (the only place a stats table is turned into a
# broadcast), and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "hourglass",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared folder and is only read.
    Only a local-mode session without the setting (tests, benches) gets a
    fresh folder under /tmp.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="hourglass-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used where one intermediate frame feeds several branches (so it is
    computed once and the logical plan stays small); survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hourglass`` importable in executor Python workers (pandas UDFs
    and grouped-map functions are pickled by module reference). Zips the
    package once per SparkContext and adds it with ``addPyFile``, the API
    form of ``--py-files``."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="hourglass-pyfiles-"), "hourglass.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
