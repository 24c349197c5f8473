"""Operators of a training-data pipeline: thirteen operators on texts, vectors, conversations and rows, each by a method of its own."""
