"""Registered queries, each with its SQL where one exists."""
