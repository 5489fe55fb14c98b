"""Operators of a training-data pipeline: crawl archives, filters, duplicates, classifiers, tokens and packing."""
