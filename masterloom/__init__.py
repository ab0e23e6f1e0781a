"""Master-data operators for PySpark.

Every operator takes and returns DataFrames built from native column
expressions, so Catalyst sees the whole plan and no Python worker is started.
"""

from masterloom.context import RunContext

__all__ = ["RunContext"]
