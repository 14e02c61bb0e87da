"""Table contracts, named filters and the jobs that build the canonical tables."""
