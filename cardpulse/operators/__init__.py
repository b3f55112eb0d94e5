"""DataFrame operators: windows, features, lookups, storage, scoring, quality."""
