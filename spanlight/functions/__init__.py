"""Scalar building blocks: native column expressions only."""
