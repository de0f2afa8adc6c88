"""Incremental rounds over pending videos and streaming sessions."""
