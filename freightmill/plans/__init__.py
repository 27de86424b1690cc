"""Finished results: gold tables, warehouse queries, measure sheets, reports, load jobs."""
