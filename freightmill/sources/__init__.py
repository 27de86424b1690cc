"""Readers: raw files, lake tables and the trade tables mapped to logistics feeds."""
