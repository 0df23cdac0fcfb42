"""Training, scoring and evaluating churn classifiers with MLlib."""
