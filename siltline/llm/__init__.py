"""Operators for preparing training text at scale, each a Spark job of its own."""
