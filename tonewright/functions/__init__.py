"""Column -> Column building blocks: cleaning, tokenizing, stemming, bigrams."""
