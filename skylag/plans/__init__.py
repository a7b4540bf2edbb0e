"""Operator chains: cleaning, model matrix, report, end-to-end job."""
