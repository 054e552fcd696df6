"""Compositions: plan columns, MLlib forecasts (M*, S10), the end-to-end batch pipeline."""
