"""End-to-end plans: snapshot features, training/scoring, model selection,
and the registered queries with their SQL oracles."""
