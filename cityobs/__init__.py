"""City observation analytics on PySpark DataFrames."""
