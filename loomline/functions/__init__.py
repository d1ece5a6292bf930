"""Column-level building blocks: seeded hashes, fixed tables, tokenizers."""
