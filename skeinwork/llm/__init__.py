"""Training-data operators: one module for each, and the registry of their queries."""
