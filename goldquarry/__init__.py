"""Curation of trusted evaluation sets and scoring of models on them, as Spark jobs."""
