"""Inputs and independent expectations for checks; not part of the library."""
