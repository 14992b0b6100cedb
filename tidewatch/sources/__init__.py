"""Readers and writers: files, payloads, versioned data sets, logs and reports."""
