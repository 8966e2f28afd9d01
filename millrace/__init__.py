"""millrace: data-pipeline building blocks for PySpark.

Every building block is a function from DataFrame to DataFrame. Column names and limits are
parameters, so one function serves any table of the right shape.
"""
