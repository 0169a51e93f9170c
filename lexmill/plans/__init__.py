"""End-to-end pipelines, and the registry of checked queries."""
