"""Composed plans: the feature build, the descriptive report, forecast evaluation, query registry."""
