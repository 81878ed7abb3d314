"""Makes the package importable where Spark's Python workers run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Local workers get the package's folder on their path; on a cluster a zip of it is sent to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        parts = sc.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
        if str(ROOT) not in parts:
            sc.environment["PYTHONPATH"] = os.pathsep.join([str(ROOT), *[p for p in parts if p]])
    elif sc.applicationId not in _shipped:
        name = Path(tempfile.mkdtemp(prefix="pressmill-")) / "pressmill.zip"
        with zipfile.ZipFile(name, "w") as z:
            for f in sorted((ROOT / "pressmill").rglob("*.py")):
                z.write(f, f.relative_to(ROOT))
        sc.addPyFile(str(name))
        _shipped.add(sc.applicationId)
