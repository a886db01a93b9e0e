"""Training, comparing and loading remaining-useful-life regressors."""
