"""Trip-mart analytics on Spark: sources, conforming, marts, checks, streams."""
