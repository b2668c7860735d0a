"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "callflow", **extra) -> SparkSession:
    """A session with the settings the library is tested under.

    On a cluster leave ``master`` out and let spark-submit name it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a folder of its own: on a cluster that would not survive its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"callflow-{application}-")


_made: list[str] = []


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{work_folder(spark)}/callflow/{uuid.uuid4().hex}"
    _made.append(path)
    return f"{path}/{name}"


@contextlib.contextmanager
def work_cleaned():
    """Deletes the work paths made inside, for jobs that write all their results elsewhere.

    Where Arrow cannot reach the folder they are left to the folder's own retention rule.
    """
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            with contextlib.suppress(pa.ArrowInvalid, OSError):
                system, inner = fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a://") else path)
                system.delete_dir(inner)
        del _made[before:]


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage so that later steps reread files that outlive any executor,
    and gives the optimizer a real size to plan the following joins with.
    """
    spark = df.sparkSession
    path = new_work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
