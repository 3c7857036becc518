"""Pipelines, fixture bindings and the registered query catalogue."""
