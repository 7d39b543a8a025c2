"""Readers for raw and cleaned data."""
