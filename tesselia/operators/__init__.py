"""Operators over tables of slides, patches, pixels and runs."""
