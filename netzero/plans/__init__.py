"""Plans: end-to-end jobs built from the operators (requests, sinks, metrics)."""
