"""Operators of a training-data pipeline: URL filters, near-duplicate joins, decontamination,
substring dedup, licence scans, language ID, source mixing, WARC archives, token counts and
quality rules.  Nothing outside this subpackage imports it."""
