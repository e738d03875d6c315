"""Operators for preparing training text: one module per operator, their queries in ``queries``."""
