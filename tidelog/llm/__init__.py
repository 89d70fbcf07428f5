"""Operators for preparing training data at scale, with their queries and checks in SQL."""
