"""terrasift.operators."""
