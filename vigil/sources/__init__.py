"""Scans and sinks: explicit schemas, key-from-file-name for the legacy
per-document layout, versioned writes for tables that are also inputs."""
