"""Storyloom: operators."""
