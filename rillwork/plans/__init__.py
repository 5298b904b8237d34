"""Whole queries over tables."""
