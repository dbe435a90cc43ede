"""vecstack — labelled-vector analytics (features, similarity joins, tree and
linear models, stacking, calibration, evaluation) as Spark DataFrame jobs."""

__version__ = "0.1.0"
