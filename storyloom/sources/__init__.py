"""Storyloom: sources."""
