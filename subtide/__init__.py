"""Subscription lifecycle analytics on Spark DataFrames."""

from subtide.config import LifecycleConfig

__all__ = ["LifecycleConfig"]
