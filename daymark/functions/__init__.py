"""Column functions: calendar, cyclic encodings, error metrics, quantiles, flattening."""
