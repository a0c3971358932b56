"""Queries that apply the operators to the driver's tables, and the SQL of the same rows."""
