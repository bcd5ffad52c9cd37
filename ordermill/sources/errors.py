"""What a failed Spark job was really about."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException


def cause(error: Exception) -> str:
    """Error condition, if there is one, and the message of the innermost cause, on one line."""
    thrown = getattr(error, "java_exception", None) if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    text = str(error)
    while thrown is not None:
        text = str(thrown.toString())
        thrown = thrown.getCause()
    first = text.strip().splitlines()[0] if text.strip() else type(error).__name__
    return first if not condition or condition in first else f"[{condition}] {first}"
