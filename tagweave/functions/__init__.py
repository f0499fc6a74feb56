"""Column expressions: text, hashing, stemming, stop words."""
