"""End-to-end jobs (PIP-1..5) and report tables (SNK-4, PIP-4)."""
