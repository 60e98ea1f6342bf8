"""Nested catalogue input derived from flat tables."""
