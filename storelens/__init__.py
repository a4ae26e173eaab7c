"""Commerce analytics jobs for PySpark: DataFrame in, DataFrame out."""
