"""Schemas, file readers and writers, label selection and shared storage."""
