"""Cleaning and scoring of raw posts as they arrive."""
