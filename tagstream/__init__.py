"""tagstream: streams of JSON sensor readings into a keyed cache or a SQL table, on Spark."""

from tagstream.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
