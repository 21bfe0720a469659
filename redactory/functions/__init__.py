"""Part of redactory; see the README."""
