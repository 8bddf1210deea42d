"""Training-data operators: corpus-scale jobs and their registered queries."""
