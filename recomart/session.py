"""Session conventions shared by every mart.

* UTC session time zone: ``DATE(ts)`` of the source warehouse is a UTC date.
* ANSI mode stays on (Spark 4 default); tolerant casts use ``try_cast``.
* AQE on, with skew-join splitting and partition coalescing, so join strategy
  (broadcast vs. sort-merge) is decided on runtime sizes, not guesses.
* ``spark.sql.codegen.hugeMethodLimit=8000``: HotSpot does not JIT-compile
  methods above 8000 bytes of bytecode, so a whole-stage-codegen method between
  8000 and 64 KB would run interpreted (several times slower than the
  non-fused fallback). Wide projections (the 65-column marts, the staging
  projections) hit this; the limit makes Spark fall back for that subtree only.
* The checkpoint folder is read from ``spark.checkpoint.dir``. A cluster must set it
  to a shared folder; a scratch one is made up only for a local master, where all
  tasks run in one process. Registered queries leave the caller's settings alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "recomart",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session with the conventions above (clusters bring their own)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conventions(spark)
    return spark


def apply_conventions(spark: SparkSession) -> None:
    """Set the runtime SQL options a mart depends on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Unset: a scratch folder on a local master, an error on a cluster."""
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - sessions without a SparkContext handle
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="recomart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local
