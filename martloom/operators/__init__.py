"""Reusable relational operators; see the modules for the plan each one aims at."""
