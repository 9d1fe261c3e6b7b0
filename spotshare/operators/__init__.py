"""Table operators: fact scan and aggregate, dated lookups, keyed merges, schema inference."""
