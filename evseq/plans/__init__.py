"""Composed stages (clean, featurize, train, evaluate) and the query catalog."""
