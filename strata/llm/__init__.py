"""Operators for training-data pipelines: near-duplicate removal, packing,
tokenization, sharding, fingerprints, language, personal data and toxicity.
Nothing else in the library imports this subpackage."""
