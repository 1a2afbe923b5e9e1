"""Whole jobs and questions put together from the operators."""
