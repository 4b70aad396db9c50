"""Readers and writers of the tables, listings and files that items come from."""
