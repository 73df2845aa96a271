"""Operators on notice tables: change detection, history, marts, index, retrieval, answers."""
