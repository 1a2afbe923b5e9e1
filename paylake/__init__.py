"""paylake: payment-risk lakehouse jobs written as plain PySpark DataFrames."""

from paylake.rules import EVENT_RULES, Rules

__all__ = ["EVENT_RULES", "Rules"]
