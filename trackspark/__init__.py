"""Detection analytics for tagged animals and fixed receivers, written as Spark DataFrame jobs.

``functions``  Column helpers (text, time).
``sources``    scans, sinks and schema checks.
``operators``  DataFrame -> DataFrame building blocks.
``plans``      the user-level jobs composed from them.
"""

from trackspark.session import build_session, configure

__all__ = ["build_session", "configure"]
