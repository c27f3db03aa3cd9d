"""Layer plans: conform (silver), serve (gold), ingest (bronze), namespaces."""
