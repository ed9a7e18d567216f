"""The package on the Python workers."""

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Only workers on the driver's own machine (a local master) are sure to see its folders; they have
    the package already when it lies in the working folder or on PYTHONPATH.
    """
    context = spark.sparkContext
    application = context.applicationId
    known = [os.path.abspath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p]
    if application in _shipped or re.match(r"local(\[|$)", context.master) and _ROOT in known:
        return
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "branchvoice"), "zip", _ROOT, "branchvoice"))
    _shipped.add(application)
