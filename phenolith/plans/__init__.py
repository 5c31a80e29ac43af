"""The three end-to-end jobs: enrich observations, fit the transform, teach a model."""
