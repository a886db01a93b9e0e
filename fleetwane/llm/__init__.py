"""Operators for training corpora: cleaning, search, mixing and tokenizing of documents."""
