"""Operators of a training-data pipeline: token counts, personal data,
language, toxicity and quality models, duplicates, decontamination and
byte-level BPE. Nothing outside this subpackage imports it."""
