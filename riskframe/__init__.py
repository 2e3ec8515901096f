"""riskframe: Spark-native risk-feature, scoring-audit and fairness tables.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects (or
plain Python constants fitted from a bounded aggregate).  Nothing is pulled to
the driver except fitted constants, tiny sweep tables and bounded vocabularies.
"""

from riskframe.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
