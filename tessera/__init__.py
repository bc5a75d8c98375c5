"""tessera: Spark-native feature engineering, statistics and evaluation.

Every public function takes and returns DataFrames (or small report
DataFrames); the heavy work is always a Spark plan.
"""

__version__ = "0.1.0"
