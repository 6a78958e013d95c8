"""terrasift.streaming."""
