"""Inputs and outputs: driver tables, entity adapters, raw CSV, table store."""
