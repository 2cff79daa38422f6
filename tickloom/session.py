"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the run-time options of the flow on the caller's session.

    Dates are derived from timestamps in UTC. State goes to RocksDB with
    changelog checkpoints, so that dedup and window state may outgrow executor
    heap and a commit uploads only what changed. Cluster sizing (shuffle
    partitions, memory, AQE thresholds) stays with whoever made the session.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def build_session(app_name: str, **options: str) -> SparkSession:
    """A session for a stand-alone job; ``options`` are extra Spark settings.

    Catalogs and connector jars are deployment matters, passed as options, e.g.
    ``**{"spark.sql.catalog.lake": "org.apache.iceberg.spark.SparkCatalog"}``.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.adaptive.enabled", "true")
    for key, value in options.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def require_utc(spark: SparkSession) -> None:
    """Fail early where dates and offset-free times would come out in another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in {"UTC", "ETC/UTC", "Z", "GMT", "+00:00"}:
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; call prepare_session(spark) to run in UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A session that names none gets it
    under the warehouse, the other folder that a cluster's executors share. All
    folders of an application are in one that goes when its driver ends.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    own = f"{root.rstrip('/')}/tickloom-{spark.sparkContext.applicationId}"
    if own not in _made:
        make_until_exit(spark, own)
        _made.add(own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


_made: set[str] = set()


def make_until_exit(spark: SparkSession, folder: str) -> None:
    """Make a folder, on whatever file system it is, that is deleted when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder but for hidden ones, sorted; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []
    return sorted(name for name in names if name[0] not in "._")


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
