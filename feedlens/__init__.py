"""Feed analytics on Spark: ingest, upsert, enrich and measure a feed of posts and comments."""
