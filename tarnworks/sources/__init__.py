"""Readers, generators and the topic stand-in."""
