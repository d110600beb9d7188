"""Vital signs: the same parsing and alerting functions for batch and stream."""
