"""Training-data operators: filters, classifiers, tokenizers, deduplication,
decontamination and exact search. Nothing outside this subpackage imports it."""
