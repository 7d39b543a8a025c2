"""Operators: ``DataFrame -> DataFrame``, lazy, no paths, no prints."""
