"""Spark-native analytics for time-stamped observations."""

from tidemark.config import LakeConfig, build_session, configure

__all__ = ["LakeConfig", "build_session", "configure"]
