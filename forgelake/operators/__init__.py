"""Relational building blocks between the layers."""
