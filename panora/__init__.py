"""panora: panel-data analytics on Spark.

Every public operator takes and returns a :class:`pyspark.sql.DataFrame`
(or a ``Column`` for scalar helpers) and is expressed with the DataFrame /
SQL API, so Catalyst plans it and the executors run it.  Only k x k
regression algebra and a handful of scalars (quantile cut-points, period
ranges) ever reach the driver.
"""

from panora.session import get_session, checkpoint_root, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
__version__ = "0.1.0"
