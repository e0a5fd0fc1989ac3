"""Operators for preparing training text, each usable by itself."""
