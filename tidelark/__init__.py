"""tidelark: localization-data analytics on PySpark DataFrames."""
