"""DataFrame → DataFrame operators: marts, audits, results, evaluation, models, tuning."""
