"""Replaying declared cleaning steps and keeping versions of a table."""
