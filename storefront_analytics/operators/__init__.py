"""Operators that Spark has no distributed built-in for."""
