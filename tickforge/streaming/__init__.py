"""Bars of a stream of ticks."""
