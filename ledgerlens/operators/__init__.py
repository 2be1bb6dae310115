"""Batch operators over request, audit and catalog tables."""
