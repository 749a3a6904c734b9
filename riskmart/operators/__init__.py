"""DataFrame operators; each takes and returns DataFrames and runs over all months at once."""
