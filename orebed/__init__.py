"""Medallion analytics on Spark: ingest, refine, model, analyse, check, observe."""

__version__ = "0.1.0"
