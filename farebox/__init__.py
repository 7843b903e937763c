"""A transit warehouse as a library of PySpark DataFrame operators."""
