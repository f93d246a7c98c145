"""Market-data quality and curation on Spark."""
