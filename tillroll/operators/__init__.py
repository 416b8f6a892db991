"""Table operators: keyed merge, quarantine, quality checks, SCD2, listing, audit."""
