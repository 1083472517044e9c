"""tidemark: lakehouse analytics on plain PySpark DataFrames."""
