"""Relational operators that Spark does not offer under one name."""
