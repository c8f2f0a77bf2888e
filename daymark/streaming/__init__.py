"""Streams of visits."""
