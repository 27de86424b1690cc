"""Relational operators: enrichment, tallies, upserts, batch loads, measures, access, quality."""
