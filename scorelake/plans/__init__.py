"""Plans: the layered table registry, refresh, and plan checks."""
