"""terrasift.sources."""
