"""hazrank — temporal risk ranking of regulated entities on Spark.

Every operator is a DataFrame / SQL expression over parquet or catalog
tables; nothing is computed on the driver beyond tiny, size-bounded
parameter frames (year spines, grid specifications).
"""

from hazrank.session import get_session, checkpoint_dir  # noqa: F401
from hazrank.config import Timeline  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "Timeline"]
