"""Column-level building blocks: tokenizers, term cleaning, scores and formats."""
