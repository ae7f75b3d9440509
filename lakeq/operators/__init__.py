"""DataFrame-in, DataFrame-out operators: refine, validate, curate, serve, profile, checks."""
