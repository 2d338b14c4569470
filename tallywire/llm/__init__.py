"""Operators for preparing training data, each by the method its module names."""
