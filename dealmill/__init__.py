"""Dealmill: CRM extract normalisation, data-quality log and management reports on Spark."""
