"""Registered queries over the provided tables and their SQL twins."""
