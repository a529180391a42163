"""End-to-end plans (Q1-Q6) composed from the operators."""
