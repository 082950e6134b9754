"""Experiment analysis: split, user metrics, transforms, tests, resampling."""
