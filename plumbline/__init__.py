"""plumbline: dataset assurance, held-out learning and metric analytics on Spark.

Every operator takes and returns Spark DataFrames (or Columns); nothing here
keeps data outside Spark.
"""

from plumbline.errors import ConfigError, DataError, ModelError, PlumblineError

__all__ = ["ConfigError", "DataError", "ModelError", "PlumblineError"]
