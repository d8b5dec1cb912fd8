"""Granary: a retail warehouse pipeline on plain Spark and Parquet.

Operational sales tables pass through landing, bronze, silver and gold layers.
Everything is lazy DataFrame code; the only actions are table writes and the
small audits around them.
"""
