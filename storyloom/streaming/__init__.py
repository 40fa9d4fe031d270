"""Storyloom: streaming."""
