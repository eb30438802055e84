"""Whole queries: labelling, evaluation, diagnostics and reports."""
