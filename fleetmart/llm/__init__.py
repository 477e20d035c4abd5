"""Operators for preparing training text: encoding, packing, scoring, deduplication, archives."""
