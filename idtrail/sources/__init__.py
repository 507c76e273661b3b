"""Readers. Every id is read as text."""
