"""Composed jobs and the registered queries with their SQL oracles."""
