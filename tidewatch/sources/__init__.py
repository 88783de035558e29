"""Readers, writers, stored artefacts and the run log."""
