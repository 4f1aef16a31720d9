"""Media acquisition and curation on Spark."""
