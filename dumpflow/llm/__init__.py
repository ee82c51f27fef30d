"""Operators that turn raw documents into language-model training data."""
