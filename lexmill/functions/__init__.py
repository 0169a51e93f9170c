"""Column expressions: tokenizers, Porter stemming, scores and record formats."""
