"""Operators for large training-data corpora: search, tokenising, archives,
language, chat format, decontamination, near copies, extraction, licences,
quality. Nothing else in the library imports this subpackage."""
