"""terrasift.plans."""
