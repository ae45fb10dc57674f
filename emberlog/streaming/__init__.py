"""Continuous runs of the same operators on a drop folder."""
