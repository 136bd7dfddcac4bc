"""Assembled pipelines, run options, the query registry and its oracle SQL."""
