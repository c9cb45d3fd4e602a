"""Subscription and product analytics as plain Spark DataFrame functions.

Layers: ``sources`` and ``streaming`` bring data in, ``functions`` are column
expressions, ``operators`` are reusable DataFrame steps, and ``plans`` are the
models, reports and data checks built from them.
"""

from subtide.params import ReportParams
from subtide.session import build_session, prepare_session

__all__ = ["ReportParams", "build_session", "prepare_session"]
