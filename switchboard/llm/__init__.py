"""Operators for preparing training data at corpus scale, and a pipeline built from them."""
