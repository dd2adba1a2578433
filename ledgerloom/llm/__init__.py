"""Operators for training-data preparation; ``queries`` holds their registered queries."""
