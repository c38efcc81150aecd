"""Loads that advance with time: batch runs from a high-water mark."""
