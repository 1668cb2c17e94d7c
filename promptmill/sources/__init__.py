"""Readers: JSON records (lines or array), chat lines, templates' job files, model rosters."""
