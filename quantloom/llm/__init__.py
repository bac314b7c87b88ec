"""Training-data operators: text scoring, near-duplicates, decontamination, scans, tokenising."""
