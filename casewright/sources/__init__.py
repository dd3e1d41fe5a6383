"""Readers, repairs, dimensions and writers."""
