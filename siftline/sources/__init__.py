"""Readers from raw payloads to normalised postings, and the CSV sink."""
