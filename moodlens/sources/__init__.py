"""Scans, sinks and the tweet-shaped views derived from the driver tables."""
