"""Python workers need this package wherever they run: on a cluster they do not see the driver's folders."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package's sources to the workers of an application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, packed = os.path.dirname(package), io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    path = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark-sources.zip")  # the driver serves it from there
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
