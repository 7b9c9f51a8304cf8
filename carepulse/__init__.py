"""Care-operations analytics as Spark DataFrame plans.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns. Nothing here collects rows to the driver or runs a Python UDF.
"""
