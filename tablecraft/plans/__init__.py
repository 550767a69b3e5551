"""Plan-shaping helpers: hot groups, ordered scans, quantiles, shared storage."""
