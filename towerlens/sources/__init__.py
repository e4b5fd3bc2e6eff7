"""Readers, writers and the tables the queries run on."""
