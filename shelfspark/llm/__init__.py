"""Operators for training text and listings; nothing outside this subpackage imports it."""
