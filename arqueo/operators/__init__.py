"""Profiling, quality, grain, consolidation, the star schema, reconciliation."""
