"""Composed jobs and the views the checks run on."""
