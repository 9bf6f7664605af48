"""The package's operators over the driver tables, with plain SQL to check them against."""
