"""terrasift.functions."""
