"""Multi-step jobs built from the operators."""
