"""The warehouse's operators; each takes and returns DataFrames."""
