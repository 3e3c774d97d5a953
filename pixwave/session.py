"""Session settings and the shared scratch folder."""

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "pixwave", **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; `conf` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCRATCH: list[str] = []


def clear_scratch() -> None:
    """Delete the scratch folders that this process has named; results that still read them must be written by then."""
    from .sources.files import filesystem
    while _SCRATCH:
        path = _SCRATCH.pop()
        with contextlib.suppress(Exception):  # not there, or a store that Arrow cannot reach
            system, inner = filesystem(path)
            system.delete_dir(inner)


atexit.register(clear_scratch)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in `spark.checkpoint.dir`, deleted when the application ends.

    Only a local master may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    base = base or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pixwave-")
        sc.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path

