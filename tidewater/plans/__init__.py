"""Datasets and reports: the registry, bronze, silver, gold, views, dashboards, tools, actions, evaluation, governance."""
