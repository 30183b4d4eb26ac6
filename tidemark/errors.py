"""Errors a caller can act on. Everything else surfaces as Spark raised it."""


class TidemarkError(Exception):
    """Base class of every error raised on purpose by this package."""


class SchemaMismatch(TidemarkError):
    """The rows do not fit the declared columns, so nothing is written."""


class ConstraintViolation(TidemarkError):
    """A NOT NULL or CHECK rule refused a row, so nothing is written."""


class MergeCardinalityError(TidemarkError):
    """Two source rows match one target row; which one wins is undefined."""


class VersionNotFound(TidemarkError):
    """No such version, or the time asked for lies before the first commit."""


class VersionExpired(TidemarkError):
    """The version existed, but its rows were given up by ``expire``."""


class RetentionTooShort(TidemarkError):
    """Expiry below the safety limit needs ``force=True``."""


class CommitConflict(TidemarkError):
    """Another writer took the version number first."""
