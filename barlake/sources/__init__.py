"""Readers: bars, raw exchange files, manifests, decisions, file inventories."""
