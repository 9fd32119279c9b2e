"""Workflow: staging -> clean -> analytics -> quality -> marts."""
