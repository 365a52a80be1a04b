"""Readers, writers and the domain tables derived from them."""
