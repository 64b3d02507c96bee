"""Operators for preparing training text; nothing else in docflow imports this subpackage."""
