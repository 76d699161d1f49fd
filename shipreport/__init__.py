"""Shipment, invoice and document reports as PySpark DataFrames."""
