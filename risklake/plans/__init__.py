"""End-to-end jobs and reports composed from sources and operators."""
