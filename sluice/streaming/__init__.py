"""Keyed state over streams of changes."""
