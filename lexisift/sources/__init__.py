"""Readers: review corpora, tokenized CSV, stop words and term lists."""
