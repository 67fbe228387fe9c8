"""Composed jobs: loads, SQL models and the registered queries."""
