"""Errors of ingestion and storage."""


class TickforgeError(Exception):
    """Base of all errors raised here."""


class CorruptedArchiveError(TickforgeError):
    """A source file that cannot be read as a trade archive."""

    #: What verification calls such a file.
    status = "corrupted"


class EmptyArchiveError(CorruptedArchiveError):
    """A source file too small to hold trades."""

    status = "empty"


class UnsupportedLayoutError(CorruptedArchiveError):
    """An archive that holds something else than one CSV."""

    status = "unsupported_layout"


class WrongMarketError(TickforgeError):
    """A source file of another market's layout."""

    status = "wrong_market"


class DiskSpaceGuardError(TickforgeError):
    """Too little free disk to go on writing."""


class VerificationFailedError(TickforgeError):
    """Stored ticks that do not match what was ingested."""
