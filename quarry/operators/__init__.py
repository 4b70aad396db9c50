"""Operators over tables of items: filters, labels, decisions, splits and reports."""
