"""Composite plans: preprocessing, training, prediction, backtest, tracking."""
