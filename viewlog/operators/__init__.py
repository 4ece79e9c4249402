"""Lazy DataFrame -> DataFrame operators: ingest, clean, features, profiles, reports, quality."""
