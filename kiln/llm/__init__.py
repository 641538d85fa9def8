"""Training-data operators: secret scan, token files, decontamination, quality rules,
near-duplicate removal, main-text extraction, substring removal, URL filter, quality
ranking and BPE by automaton. Nothing else in the library imports this subpackage."""
