"""Operators for training-data pipelines (see the README, "Training-data operators").

Nothing outside this subpackage imports it; ``queries`` registers its queries.
"""
