"""Readers and writers: files, document exports, named collections, the supplied tables."""
