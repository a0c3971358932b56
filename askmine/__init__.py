"""Question mining on Spark: from a message archive to a short list of recurring questions."""
