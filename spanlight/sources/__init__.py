"""Readers and writers: streams, log files, stored tables."""
