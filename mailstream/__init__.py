"""Mail event streams on Spark: decode, enrich, count, publish."""
