"""Spectrum-allocation jobs on Spark: interval joins, tiling checks, table parsing."""
