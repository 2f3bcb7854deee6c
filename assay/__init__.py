"""Evidence jobs on Spark: DataFrame in, DataFrame out."""
