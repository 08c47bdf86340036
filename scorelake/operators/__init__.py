"""DataFrame operators: cleaning (silver), gold aggregates, serving, board."""
