"""Handing a loaded table to a consumer batch by batch."""
