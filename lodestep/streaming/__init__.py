"""Continuous forms of the stage counts and the row rules."""
