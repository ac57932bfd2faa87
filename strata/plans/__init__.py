"""Whole layers put together from the operators."""
