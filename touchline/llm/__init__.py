"""Corpus operators for large text collections: scoring, archives, joins, classifiers, mixing and sharding."""
