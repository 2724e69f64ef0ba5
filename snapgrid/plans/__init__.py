"""Batch jobs made of the operators."""
