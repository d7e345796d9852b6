"""Operators for preparing training text: each works on whole tables and whole texts."""
