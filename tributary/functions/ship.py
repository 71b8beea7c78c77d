"""Getting this package to where Python functions run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, which may have neither it nor the driver's folder. Once per session."""
    context = spark.sparkContext
    name = f"tributary-{os.getpid()}.zip"
    if name in context._python_includes:
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="tributary-")) / name
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
