"""Registered queries over the test tables, each with the SQL that must give the same rows."""


def load():
    """The registry, with all query modules imported."""
    from checks import detection, registry, state, stored, streams  # noqa: F401

    return registry
