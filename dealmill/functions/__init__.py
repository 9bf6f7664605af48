"""Column functions: cleaning and normalising text cells."""
