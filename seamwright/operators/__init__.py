"""Operators on corpora, topics, insights and distributions."""
