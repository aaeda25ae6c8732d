"""Scalar functions: every one returns a Column, so the optimizer sees through it."""
