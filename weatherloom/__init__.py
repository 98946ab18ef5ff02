"""weatherloom: sensor-reading analytics on Spark.

Every operator is a plain function from DataFrame to DataFrame, built from
Spark's own expressions, so that it can be chained with ``DataFrame.transform``
and planned as a whole.
"""
