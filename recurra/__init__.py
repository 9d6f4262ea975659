"""Subscription-business analytics as composable Spark DataFrame operators."""

from recurra.settings import Settings

__all__ = ["Settings"]
