"""Whole jobs: one builder per entity, the full load, the reports and the catalogue."""
