"""Whole plans: input views, the area table, the queries and their SQL twins."""
