"""Storyloom: functions."""
