"""Forge-event analytics on Spark: bronze JSON, sparse silver, star-schema gold."""
