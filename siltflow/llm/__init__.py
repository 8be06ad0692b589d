"""Operators for preparing training text: extraction, cleaning, de-duplication, packing.

Nothing outside this package imports it.
"""
