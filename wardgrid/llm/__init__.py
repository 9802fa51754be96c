"""Operators for training-data pipelines: archives, extraction, language, duplicates,
sharding, decontamination, token files, nearest neighbours, toxicity and mixing.

Nothing else in the library imports this subpackage.
"""
