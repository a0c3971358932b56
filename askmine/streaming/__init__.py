"""Shards as a stream."""
