"""DataFrame-to-DataFrame building blocks: cleaning, audits, star schema, marts."""
