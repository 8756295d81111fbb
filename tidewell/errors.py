"""Errors of a load."""


class LoadError(Exception):
    """Any failure of a load."""


class SourceError(LoadError):
    """The source can't be read: a bad file, a bad query, a refused connection."""


class IoError(LoadError):
    """A file or table is missing, or is there and mustn't be."""


class TableFormatError(LoadError):
    """A table's log or metadata can't be understood."""


class ConcurrencyError(LoadError):
    """Another writer committed first, in every attempt."""


class BadInputError(LoadError):
    """The request contradicts itself or the table: flags, or a schema that doesn't fit."""


class UnsupportedTypeError(LoadError):
    """A column has a type that the source or the sink doesn't take."""
