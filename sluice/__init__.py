"""Sluice: medallion cleaning, quarantine, quality and analytics on Spark DataFrames."""
