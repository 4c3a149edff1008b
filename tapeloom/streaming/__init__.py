"""Bars and indicators from streams."""
