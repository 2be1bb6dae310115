"""Readers and writers for segmented JSON logs."""
