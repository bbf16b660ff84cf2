"""Training-data operators: filtering, deduplication, decontamination, mixing, sharding, scoring."""
