"""Workflow definitions as tables: extract, check and synchronise them with Spark."""
