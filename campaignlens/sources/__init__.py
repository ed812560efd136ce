"""Readers, writers and the warehouse-to-customer mapping."""
