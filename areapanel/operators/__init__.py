"""DataFrame steps: checks, columns, relational, time series, spatial, features, models."""
