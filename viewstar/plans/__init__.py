"""Composite plans: the star model, the KPI tables and the dated job."""
