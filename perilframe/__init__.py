"""Property-insurance exposure analytics, written as PySpark DataFrame jobs."""

from perilframe.params import Alive, InForce, RunParams

__all__ = ["Alive", "InForce", "RunParams"]
