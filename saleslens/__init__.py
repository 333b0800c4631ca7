"""Retail analytics, data checks, features and forecasts as Spark jobs."""
