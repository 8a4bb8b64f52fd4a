"""Planning of presentations from evidence: contracts, prompts, references, and calls of an injected generator."""
