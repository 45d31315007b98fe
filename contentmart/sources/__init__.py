"""Readers, writers, staging and publishing."""
