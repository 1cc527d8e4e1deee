"""Staging views, enriched models, reporting marts and the detection flow over named tables."""
