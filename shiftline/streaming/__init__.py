"""Booking as records arrive."""
