"""Scalar expressions and the user-function surface."""
