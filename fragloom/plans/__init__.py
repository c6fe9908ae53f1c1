"""Whole jobs, the query API, and the driver's queries with their SQL."""
