"""Road-safety analytics on Spark: blackspots, corridors and temporal patterns."""
