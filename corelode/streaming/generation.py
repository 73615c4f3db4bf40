"""Superseded work: the only state over time that the catalogue has.

A newer request of a surface makes older ones void: their Spark jobs are cancelled
and their results are not shown.
"""

from __future__ import annotations

import itertools
import threading
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


class Generation:
    """Requests of one surface; only the latest may deliver."""

    def __init__(self, spark: SparkSession, surface: str):
        self.spark, self.surface = spark, surface
        self._count, self._lock, self.current = itertools.count(1), threading.Lock(), 0

    def _group(self, token: int) -> str:
        return f"{self.surface}-{token}"

    def begin(self) -> int:
        """A new token; the jobs of the one before are cancelled."""
        with self._lock:
            old, self.current = self.current, next(self._count)
        if old:
            self.spark.sparkContext.cancelJobGroup(self._group(old))
        return self.current

    def allowed(self, token: int) -> bool:
        return token == self.current

    def run(self, work: Callable[[], T]) -> T | None:
        """The result of ``work``, or None where a newer request came meanwhile."""
        token = self.begin()
        self.spark.sparkContext.setJobGroup(self._group(token), self.surface, True)
        try:
            out = work()
        except Exception:
            if not self.allowed(token):
                return None
            raise
        return out if self.allowed(token) else None
