"""Entity cleaning, regional marts and the full run."""
