"""Readers and writers for reviews, line corpora and staged tables."""
