"""Training, evaluation and scoring of rainfall-class models with MLlib."""
