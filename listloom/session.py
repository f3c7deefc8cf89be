"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession


# Above this many bytes of bytecode the JVM leaves a method interpreted. Spark splits
# expressions into smaller methods once a fused stage would exceed the limit.
JIT_LIMIT = 8000


def tune(spark: SparkSession) -> SparkSession:
    """Set what every job here relies on: UTC, and methods small enough to be compiled."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)
    return spark


def builder(master: str | None = None, app: str = "listloom") -> SparkSession.Builder:
    """A session builder with the settings the library relies on."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)
        # Intermediate tables go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Without it every column expression built in Python records its call site.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return b.master(master) if master else b


def require_utc(spark: SparkSession) -> None:
    """Instants are rendered in the session zone, so it has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, else one below the warehouse.

    The rule is the same for every master; the driver's own disk is never used.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_listloom"
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir().rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once no result of it is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def load_if_there(reader: DataFrameReader, path: str, kind: str) -> DataFrame | None:
    """``None`` for a folder nobody has written; any other fault is raised."""
    try:
        return reader.format(kind).load(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def store(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Compute once into the shared folder as Parquet, of which later plans read the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder and cut the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
