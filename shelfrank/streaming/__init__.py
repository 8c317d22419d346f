"""Structured Streaming recommender."""
