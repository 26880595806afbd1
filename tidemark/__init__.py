"""Clickstream analytics on Spark: decode, route, count, time and store web/app events."""
