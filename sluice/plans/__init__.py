"""Whole jobs built from the operators: the claims job and the job template."""
