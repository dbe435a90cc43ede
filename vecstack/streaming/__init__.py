"""Streaming.

The reference processes two fixed files per run and has no stream, watermark,
trigger or state, so nothing here is a streaming operator.  Every *fitted*
transform of this package (scalers, PCA projection, image features, linear /
tree / boosted scoring, Platt calibration, override rules) is a narrow
per-row projection or ``mapInPandas`` stage with its parameters held as
literals or in the task closure, so it can be applied unchanged to a
``readStream`` DataFrame; fitting stays a batch job.
"""
