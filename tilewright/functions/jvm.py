"""``Tries.java`` as a function of Spark's, compiled by the compiler that Spark has for its own code (Janino), once an application.

The driver gives the classes to the executors as a jar, as ``ADD JAR`` does. A session that has no JVM at hand (Spark
Connect) gets none, and callers use numpy.
"""

from __future__ import annotations

import atexit
import pkgutil
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_NAME, _CLASS = "tilewright_tries", "tilewright.Tries"
#: The applications whose executors have been given the classes, and what makes the function there.
_GIVEN: dict[str, object] = {}


def _given(spark: SparkSession) -> object:
    """The function's object, its classes given to the executors."""
    context = spark.sparkContext
    if context.applicationId not in _GIVEN:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(pkgutil.get_data(__package__, "Tries.java").decode())
        folder = tempfile.mkdtemp(prefix="tilewright-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        jar = Path(folder, "tilewright-tries.jar")
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in compiler.getBytecodes().items():
                z.writestr(name.replace(".", "/") + ".class", bytes(code))
        context._jsc.addJar(str(jar))
        _GIVEN.clear()
        _GIVEN[context.applicationId] = compiler.getClassLoader().loadClass(_CLASS).newInstance()
    return _GIVEN[context.applicationId]


def tries(spark: SparkSession) -> Callable[..., Column] | None:
    """The function of ``Tries.call``'s arguments."""
    if not hasattr(spark, "_jsparkSession"):
        return None
    made = _given(spark)
    binary = spark._jsparkSession.parseDataType('"binary"')
    spark._jsparkSession.udf().register(_NAME, made, binary)
    return lambda *args: F.call_function(_NAME, *args)
