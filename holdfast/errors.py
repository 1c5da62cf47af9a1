"""Refusals. Each class has its own cure, so each has its own name."""


class DataNotFoundError(FileNotFoundError):
    """No candidate location holds the input file."""


class SchemaError(ValueError):
    """Base class of every contract refusal."""


class MissingColumnsError(SchemaError):
    """A required column is absent."""


class ColumnTypeError(SchemaError):
    """A column is present but holds the wrong kind of value."""


class ValueRangeError(SchemaError):
    """A column holds values outside its contract range."""


class DomainError(ValueError):
    """A transform was given values it is not defined on."""


class UnsafeEncoderError(ValueError):
    """An encoder setting would make two categories identical."""


class RecordExistsError(FileExistsError):
    """A write-once record is already there."""
