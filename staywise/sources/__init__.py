"""Readers, writers and the adapters from raw tables to the three canonical inputs."""
