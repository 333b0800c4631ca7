"""Composed jobs: base table, features, campaigns, customers, catalogue, forecasts."""
