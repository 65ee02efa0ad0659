"""seqloom: ordered-sequence, interval and genome-variation analytics on Spark DataFrames."""
