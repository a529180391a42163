"""DataFrame operators: lookups, flattening, unwrapping, picks, counts."""
