"""Inputs and expected results for checking the library."""
