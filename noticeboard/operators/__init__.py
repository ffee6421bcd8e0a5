"""Table-level steps: DataFrame in, DataFrame out."""
