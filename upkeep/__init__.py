"""upkeep: predictive-maintenance analytics as lazy Spark DataFrame transformations.

Every public operator is a ``DataFrame -> DataFrame`` function (or returns a
small bundle of DataFrames).  Nothing is collected to the driver except tiny,
provably bounded metadata (column lists, category vocabularies capped by rule).
"""

from upkeep.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
