"""Entity-resolution operators: DataFrame in, DataFrame out."""
