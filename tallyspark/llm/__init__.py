"""Operators that prepare training text: deduplication, decontamination, language, packing, formatting, privacy."""
