"""Operators for preparing training text: one module per operator, each with a
general DataFrame interface; ``queries`` registers the thin digest queries."""
