"""Dialogue-data engine on PySpark: parse, convert, gate, curate, judge and report."""
