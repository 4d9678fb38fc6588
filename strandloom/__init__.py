"""Digestion and pairing of long multi-contact sequencing reads, and corpus preparation, on Spark."""
