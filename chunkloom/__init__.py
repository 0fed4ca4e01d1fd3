"""Transcript-chunk analytics on Spark: build, export, summarise and serve chunk tables."""
