"""Operators for preparing a training corpus, each on whole documents."""
