"""Operators of a training-data pipeline: tokens, near-duplicates, language,
archives, fingerprints, surrogates and mixing. Nothing else in the library
imports this subpackage."""
