"""Composed plans: the feature panel and the forecast/allocation plan."""
