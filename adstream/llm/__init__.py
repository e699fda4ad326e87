"""Operators for preparing training text, and the pipeline that chains them."""
