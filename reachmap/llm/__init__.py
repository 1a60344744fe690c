"""Training-data operators: filtering, deduplication, archives and scoring."""
