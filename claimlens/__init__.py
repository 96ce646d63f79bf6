"""claimlens: Spark-native data quality, drift, preparation and modelling
for motor-policy claim records.

Every operator is a function from DataFrames to DataFrames that runs over
all batches at once; see README.md for the module map.
"""

from claimlens.settings import Settings, DEFAULTS
from claimlens.session import get_spark, scratch_dir

__all__ = ["Settings", "DEFAULTS", "get_spark", "scratch_dir"]
