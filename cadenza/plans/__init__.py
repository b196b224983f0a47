"""Plans: ordering helpers, the pipeline, and the registered queries."""
