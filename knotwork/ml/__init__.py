"""Training, scoring and calibration of match classifiers."""
