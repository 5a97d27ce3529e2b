"""marketloom: DataFrame-to-DataFrame building blocks for daily market panels on Spark."""
