"""Operators put together: the lazy star schema and the nightly load."""
