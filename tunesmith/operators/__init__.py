"""The operators; each takes and returns DataFrames."""
