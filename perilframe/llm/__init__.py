"""Operators for large text, media and dialogue corpora. Nothing else in the library imports this subpackage."""
