"""pulsekit: product analytics and experiment statistics on Spark.

Every public function takes DataFrames (or a SparkSession plus a data
location) and returns a lazy DataFrame.  Nothing is collected except
bounded, parameter-sized values (range boundaries, a checkpoint path).
"""

from pulsekit.params import Params, DEFAULT_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS"]
