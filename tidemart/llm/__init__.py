"""Operators that prepare text for model training; nothing outside this subpackage imports it."""
