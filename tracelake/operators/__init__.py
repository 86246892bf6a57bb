"""Queries over entries, hashes, text and images, as functions from DataFrame to DataFrame."""
