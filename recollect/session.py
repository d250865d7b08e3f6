"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Long hexadecimal literals, which is how keys would show in plans.
REDACTED = r"(?i)\b(0x|x')?[0-9a-f]{48,}'?"


def build_session(app_name: str = "recollect", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the jobs expect; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.redaction.string.regex", REDACTED)
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to this machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="recollect-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
