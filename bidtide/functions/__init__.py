"""Column expressions: business rules, time handling, one-hot encoding and scoring."""
