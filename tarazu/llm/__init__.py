"""Operators for language-model corpora; nothing outside this folder imports it."""
