"""Cross-validated regression: hash folds, population scaling, fold metrics,
linear models from per-fold sufficient statistics, Spark ML tree families,
grid / seeded random search, averaging ensembles and batch scoring."""
