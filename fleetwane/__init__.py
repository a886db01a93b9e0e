"""Fleet health analytics on Spark: panels of sensor readings in, health features,
remaining-useful-life models, risk tables and profiles out.

Every operator takes and returns DataFrames built from Spark's own expressions.
"""

__version__ = "0.1.0"
