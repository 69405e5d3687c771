"""Content-moderation analytics on Spark: land, clean, featurise, match, route, monitor."""
