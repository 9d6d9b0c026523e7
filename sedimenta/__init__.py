"""Medallion analytics on Spark: catalogue, map, conform, layer, check and query drifting Parquet files."""
