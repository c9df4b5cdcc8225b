"""Registered queries, grouped by subject."""

from importlib import import_module

SUBJECTS = ["scoring", "preparation", "modeling", "intake", "operations", "experiments", "streams", "models"]


def load_all() -> None:
    for subject in SUBJECTS:
        import_module(f"millrace.plans.{subject}")
