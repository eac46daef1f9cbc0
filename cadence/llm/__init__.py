"""Operators for preparing large text corpora (decontamination, PII,
near-duplicates, mixing, toxicity, token output, line and web-archive work,
vector search, language id).  Nothing outside this subpackage imports it."""
