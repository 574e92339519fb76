"""Errors a caller may want to tell apart."""


class EmptyInput(Exception):
    """No input file matches the path or the requested days."""


class ModelNotFound(Exception):
    """No published model version exists under the model directory."""


class MalformedBaskets(Exception):
    """The basket table has no category columns, or lacks an id column."""


class MalformedKey(ValueError):
    """A key that is not ``dow:hour:category``."""
