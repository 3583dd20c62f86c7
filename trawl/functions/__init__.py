"""Column expressions: cleaning, analysis, stemming, scoring."""
