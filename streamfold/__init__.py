"""streamfold: keyed-event analytics (moderation, folds, change feeds,
metrics) written as DataFrame-to-DataFrame functions on Spark SQL."""

__version__ = "0.1.0"
