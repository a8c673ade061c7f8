"""Readers and writers: corpus tables (S1, S2), stop lists (S8), saved indexes (S3–S5),
feature tables (S6), media listings (S7), reduction models (S9), size prefixes (S10)."""
