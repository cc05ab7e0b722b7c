"""Operators over tables that grow while they are read."""
