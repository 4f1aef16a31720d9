"""Stages that run the operators in order and write their tables."""
