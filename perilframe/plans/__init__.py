"""Peril footprints, audit and the query registry."""
