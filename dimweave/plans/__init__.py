"""Whole loads put together from operators."""
