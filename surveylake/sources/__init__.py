"""Archives, delimited text, Parquet layers and the catalog."""
