"""Regulatory-genomics analytics as Spark DataFrame operators."""

from .runtime import configure, shared_dir

__all__ = ["configure", "shared_dir"]
