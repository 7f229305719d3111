"""DataFrame-level operators: profiling, lexicon jobs, features, models and metrics."""
