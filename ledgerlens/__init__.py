"""Payment transaction analytics and fraud detection on Spark DataFrames."""
