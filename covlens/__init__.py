"""covlens — event-coverage analytics on Spark DataFrames.

Every operator takes DataFrames and column names, returns a lazy DataFrame,
and is built only from Spark's built-in functions so that Catalyst and
whole-stage code generation do the work.
"""

from covlens.session import get_spark, shared_dir  # noqa: F401

__all__ = ["get_spark", "shared_dir"]
