"""Column-level building blocks: window specs, rolling statistics, labels."""
