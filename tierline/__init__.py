"""Layered batch pipelines for trip tables on Spark."""
