"""Training-data operators on Spark: tokens, quality, toxicity, duplicates,
archives, mixing and page text. Nothing outside this subpackage imports it."""
