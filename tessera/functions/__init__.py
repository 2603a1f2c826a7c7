"""Scalar expressions: text normalisation, decision statuses, comparison statistics."""
