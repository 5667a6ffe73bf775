"""Joins, windows, dedup, gap, anomaly and comparison operators over event tables."""
