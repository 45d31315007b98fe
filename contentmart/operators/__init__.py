"""Relational operators of the load engine (DataFrame -> DataFrame)."""
