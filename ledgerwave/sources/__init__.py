"""Feeds in, layers out."""
